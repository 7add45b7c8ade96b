"""Raw listings to typed, validated rows: cleaning in one projection, rules in one pass, rejects with their reasons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify, keys, numbers, text

COMMON = ["line", "vehicle_key", "source_platform", "source_id", "match_key", "title_raw", "brand", "model", "price_wan", "new_car_price_wan", "retention_rate",
    "mileage_km", "reg_year", "reg_month", "transfer_count", "location_city", "detail_url"]
EV = ["battery_type", "range_km", "range_standard", "battery_health", "fast_charge_kw"]
FUEL = ["displacement_l", "gearbox", "emission_standard"]


def normalize(raw: DataFrame, as_of: str, base_url: str | None = None, keep: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """raw listings (texts) -> the clean columns of both lines (those of the other line NULL) and ``keep``. A NULL
    anywhere stays NULL. No shuffle. A chain of projections: texts are squeezed, null tokens go, texts are cut, cuts become numbers, numbers are
    judged and combined. What a step reads twice is a column of the step before, so that no rule is written out twice in the plan and hardly any
    needs a lambda, which is not compiled. Texts of one line are cleaned for that line only."""
    both = ["source_platform", "source_id", "title_raw", "brand_raw", "model_raw", "price_raw", "new_car_price_raw", "mileage_raw", "reg_date_raw", "transfer_raw", "city_raw", "detail_url"]
    of_ev, of_fuel = ["battery_raw", "range_raw", "battery_health_raw", "fast_charge_raw"], ["displacement_raw", "gearbox_raw", "emission_raw"]
    ev, fuel = F.col("line") == "ev", F.col("line") == "fuel"
    line = text.let("line", lambda line: line).alias("line")  # keeps a projection out of whole-stage code, see let()
    of = lambda c: F.col(f"_{c}")
    texts = {c: text.squeeze(c) for c in both} | {c: F.when(ev, text.squeeze(c)) for c in of_ev} | {c: F.when(fuel, text.squeeze(c)) for c in of_fuel}
    missing = lambda c: F.coalesce(texts[c].isin(*text.NULL_TOKENS), F.lit(True))
    fallback = F.when(missing("source_id"), text.clean_text(keys.fingerprint("title_raw", "price_raw", "mileage_raw")))
    untold = F.when(missing("brand_raw") | missing("model_raw"), F.col("title_raw"))  # only titles that brand or model is read from
    row = raw.select(line, *keep, fallback.alias("_print"), untold.alias("_untold"), *[t.alias(f"_{c}") for c, t in texts.items()])
    row = row.select(line, *keep, "_print", "_untold", *[text.known(f"_{c}").alias(f"_{c}") for c in texts])
    plain = lambda c: numbers.first(F.replace(of(c), F.lit(","), F.lit("")), numbers.AMOUNT)
    signed = lambda c: numbers.first(of(c), f"-?{numbers.AMOUNT}")
    row = row.withColumns({
        "line": line, "_upper_brand": F.upper(of("brand_raw")), "_upper_battery": F.upper(of("battery_raw")), "_upper_range": F.upper(of("range_raw")), "_upper_gearbox": F.upper(of("gearbox_raw")),
        "_upper_emission": F.upper(F.replace(of("emission_raw"), F.lit(" "), F.lit(""))), "_told": of("brand_raw").isNotNull() & of("model_raw").isNotNull(), "_own": F.coalesce(of("source_id"), of("print")),
        "_price": plain("price_raw"), "_new_price": plain("new_car_price_raw"), "_mileage": plain("mileage_raw"), "_year": numbers.first(of("reg_date_raw"), numbers.YEAR), "_month": numbers.first(of("reg_date_raw"), numbers.MONTH, 1),
        "_transfer": signed("transfer_raw"), "_health": signed("battery_health_raw"), "_charge": signed("fast_charge_raw"), "_range": numbers.first(of("range_raw"), numbers.RANGE, 1), "_litres": numbers.first(of("displacement_raw"), numbers.LITRES),
        "_city": F.regexp_replace(of("city_raw"), "[市区县]$", ""),
    })
    row = row.withColumns({
        "line": line, "_guess": F.when(~F.col("_told"), classify.split_title("_untold")), "_price": F.bround(numbers.number("_price", "decimal(30,8)"), 2), "_new_price": F.bround(numbers.number("_new_price", "decimal(30,8)"), 2),
        "_mileage": numbers.number("_mileage", "double"), "_year": numbers.number("_year", "int"), "reg_month": numbers.number("_month", "int"), "transfer_count": numbers.int_value(of("transfer")),
        "_health": numbers.number("_health", "double"), "_charge": numbers.number("_charge", "double"), "_range": F.coalesce(numbers.number("_range", "int"), numbers.int_of(of("range_raw"))),
        "_litres": numbers.number("_litres", "double"), "location_city": F.when(of("city") != "", of("city")),
    })
    row = row.withColumns({
        "line": line, "_price": numbers.price_value(of("price"), of("price_raw")), "_new_price": numbers.price_value(of("new_price"), of("new_car_price_raw")), "mileage_km": numbers.mileage_value(of("mileage"), of("mileage_raw")),
        "reg_year": numbers.sane_year("_year", as_of), "range_km": F.when(ev, numbers.range_value(of("range"))),
        "battery_health": F.when(ev & (of("health") > 0) & (of("health") <= 100), F.bround(of("health"), 1)).try_cast("decimal(5,1)"), "fast_charge_kw": F.when(ev, F.bround(of("charge"), 1)).try_cast("decimal(6,1)"),
        "displacement_l": F.when(fuel, numbers.litres_value(of("litres"))).cast("decimal(4,1)"),
        "battery_type": F.when(ev, classify.class_of(of("upper_battery"), classify.BATTERY)), "range_standard": F.when(ev, numbers.standard_of(of("upper_range"))),
        "gearbox": F.when(fuel, classify.class_of(of("upper_gearbox"), classify.GEARBOX)), "emission_standard": F.when(fuel, classify.class_of(of("upper_emission"), classify.EMISSION_CLASSES)),
        "brand": F.when(F.col("_told"), classify.brand_of(of("brand_raw"), of("upper_brand"))).otherwise(F.col("_guess.brand")), "model": F.when(F.col("_told"), of("model_raw")).otherwise(F.col("_guess.model")),
        "vehicle_key": keys.key_of(of("source_platform"), of("own")), "source_platform": of("source_platform"), "source_id": of("source_id"), "title_raw": of("title_raw"), "detail_url": text.absolute(F.lit(base_url), of("detail_url")),
    })
    row = row.withColumns({
        "line": line, "price_wan": numbers.nonzero(of("price")), "new_car_price_wan": numbers.nonzero(of("new_price")), "match_key": keys.match_key_of("brand", "model", "reg_year", "mileage_km", "reg_month"),
    })
    row = row.withColumn("retention_rate", numbers.safe_ratio("price_wan", "new_car_price_wan").cast("decimal(8,4)"))
    return row.select(*COMMON, *EV, *FUEL, *keep)


def rules() -> dict[str, Column]:
    """Name -> what a bad row does."""
    outside = lambda c, low, high: ~F.col(c).between(low, high)
    return {
        "price_wan": F.col("price_wan").isNull() | (F.col("price_wan") <= 0),
        "vehicle_key": F.col("vehicle_key").isNull() | ~F.char_length("vehicle_key").between(8, 64),
        "mileage_km": outside("mileage_km", 0, 1_500_000),
        "transfer_count": outside("transfer_count", 0, 30),
        "reg_month": outside("reg_month", 1, 12),
        "fast_charge_kw": outside("fast_charge_kw", 0, 1000),
        "range_km": outside("range_km", 0, 2000),
        "battery_health": ~((F.col("battery_health") > 0) & (F.col("battery_health") <= 100)),
        "displacement_l": ~F.col("displacement_l").between(0.6, 8.0),
    }


def validate(rows: DataFrame) -> DataFrame:
    """rows with ``violations``: the names of the rules a row breaks, empty if none (a NULL breaks only rules that ask for a value).

    The condition on the partition's number always holds. It makes the column one that the optimizer may not copy, so that a
    filter on it stays above: pushed below, it would spell out every cleaning rule once more, in an expression that takes minutes to plan.
    """
    bad = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules().items()}
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in bad.items()]))
    found = F.when(reduce(or_, bad.values()), broken).otherwise(F.array().cast("array<string>"))  # names are listed only of bad rows
    return rows.withColumn("violations", F.when(F.spark_partition_id() >= 0, found))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") == 0).drop("violations")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") > 0)


def reject_samples(validated: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rejects of each group with title and reason, and how many there are. Each task keeps the first n of what it has of a
    group before the shuffle, and the counts are added up apart, so no group is held anywhere."""
    found = rejected(validated)
    first = found.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("place") <= n)
    shown = first.select(*by, "place", F.concat_ws(" -> ", "title_raw", F.array_join("violations", ",")).alias("sample")).alias("s")
    counts = found.groupBy(*by).agg(F.count("*").alias("rejects")).alias("c")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    return shown.join(counts, same).select(*[f"s.{c}" for c in by], "place", "rejects", "sample")


def dedupe_last(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """The last row of each key by ``order``; rows without a key are dropped. Each task keeps the last row of what it has of a key
    before the shuffle, so a very frequent key meets as one row a task. Of ``columns`` (default: all) those that are read go through it.
    ``where``: only those last rows for which it holds; of other rows the shuffle gets what they compete with for a key, and no more."""
    names = list(columns or rows.columns)
    rows = rows.filter(F.col(key).isNotNull())
    if where is not None:
        rows = rows.withColumn("_wanted", F.coalesce(where, F.lit(False)))
        rows = rows.select("_wanted", *dict.fromkeys([key, *order]), *[F.when(F.col("_wanted"), F.col(c)).alias(c) for c in names if c not in (key, *order)])
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    last = rows.withColumn("_place", place).filter("_place = 1")
    return (last if where is None else last.filter("_wanted")).select(*names)
