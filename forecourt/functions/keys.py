"""Keys of listings, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, clean_text, let

MILEAGE_STEP = 5_000


def vehicle_key(platform, source_id, fallback=None) -> Column:
    """Eight characters of the platform and the MD5 of platform and id; without an id, of the fallback."""
    own = clean_text(source_id) if fallback is None else F.coalesce(clean_text(source_id), clean_text(fallback))
    return let(clean_text(platform), lambda name: key_of(name, own))


def key_of(platform: Column, own: Column) -> Column:
    """vehicle_key() of a cleaned platform and id."""
    name = F.coalesce(platform, F.lit("unknown"))
    return F.concat(F.substr(name, F.lit(1), F.lit(8)), F.lit("_"), F.md5(F.concat(name, F.lit("|"), F.coalesce(own, F.lit(""))).cast("binary")))


def fingerprint(*parts) -> Column:
    """Parts joined by bars, a missing one as an empty text."""
    return F.concat_ws("|", *[F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts])


def match_key(brand, model, year, mileage, month) -> Column:
    """Same vehicle on several platforms: brand, model, year, month and mileage step; NULL without brand, model or year."""
    return match_key_of(clean_text(brand), clean_text(model), year, mileage, month)


def match_key_of(brand: str | Column, model: str | Column, year, mileage, month) -> Column:
    """match_key() of a cleaned brand and model."""
    year, month, km = as_column(year), as_column(month), as_column(mileage)
    step = F.when(km >= 0, F.floor(km / MILEAGE_STEP).cast("string"))
    bar = F.lit("|")
    return F.concat(as_column(brand), bar, as_column(model), bar, year.cast("string"), bar, F.coalesce(F.lpad(month.cast("string"), 2, "0"), F.lit("na")), bar, F.coalesce(step, F.lit("na")))
