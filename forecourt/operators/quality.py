"""Data quality of runs: missing fields, drift, status, alerts, volumes and reconciliation with the raw texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify, numbers

DRIFT = 0.3


def field_missing(raw: DataFrame, fields: Sequence[str], by: Sequence[str], missing: Sequence[str] = ("",)) -> DataFrame:
    """Share of rows without a value (NULL or one of ``missing``), by group and raw field, and whether it drifts."""
    share = [F.round(F.avg(F.when(F.col(c).isNull() | F.col(c).isin(*missing), 1.0).otherwise(0.0)), 4).alias(c) for c in fields]
    wide = raw.groupBy(*by).agg(*share)
    return wide.unpivot(list(by), list(fields), "field", "missing").withColumn("drift", F.col("missing") > DRIFT)


def worst_field(missing: DataFrame, by: Sequence[str]) -> DataFrame:
    """The largest and the mean missing share of each group."""
    return missing.groupBy(*by).agg(F.max("missing").alias("worst"), F.round(F.avg("missing"), 4).alias("overall"), F.max_by("field", F.struct("missing", "field")).alias("worst_field"))


def drift_gate(missing: DataFrame, fail: bool = False, threshold: float = DRIFT) -> DataFrame:
    """Drifting fields; with ``fail`` the job stops if there is one."""
    found = missing.filter(F.col("missing") > threshold)
    if fail and not found.isEmpty():
        raise ValueError("fields drift: " + ", ".join(sorted(r["field"] for r in found.select("field").distinct().limit(50).collect())))
    return found


def run_counters(validated: DataFrame, by: Sequence[str], key: str = "vehicle_key") -> DataFrame:
    """parsed, accepted, rejected and duplicate rows of each group."""
    ok = F.size("violations") == 0
    return validated.groupBy(*by).agg(F.count("*").alias("parsed"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), (F.count_if(ok) - F.countDistinct(F.when(ok, F.col(key)))).alias("duplicates"))


def run_status(counters: DataFrame, threshold: float = DRIFT) -> DataFrame:
    """counters(parsed, errors, missing_ratio, circuit_broken) with status: a broken circuit is partial, nothing parsed failed, errors or
    drift partial, else success."""
    status = F.when(F.col("circuit_broken"), "partial").when(F.col("parsed") == 0, "failed").when((F.col("errors") > 0) | (F.col("missing_ratio") > threshold), "partial").otherwise("success")
    return counters.withColumn("status", status)


def merge_counters(merged: DataFrame, by: Sequence[str]) -> DataFrame:
    """inserted and updated rows of upsert.merge() by group."""
    return merged.groupBy(*by).agg(F.count_if(F.col("action") == "insert").alias("inserted"), F.count_if(F.col("action") == "update").alias("updated"))


def list_run_status(counters: DataFrame, threshold: float = DRIFT) -> DataFrame:
    """The rule of list pages, counters(pages_ok, errors, missing_ratio): no page read is failed, errors or drift partial, else success."""
    return counters.withColumn("status", F.when(F.col("pages_ok") == 0, "failed").when((F.col("errors") > 0) | (F.col("missing_ratio") > threshold), "partial").otherwise("success"))


def log_rows(log: DataFrame) -> DataFrame:
    """The run log as it is shown: seconds and percent to one digit, details cut to 300 characters."""
    return log.select(
        F.coalesce(F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"), F.lit("-")).alias("time"), F.col("business_line").alias("line"), F.col("source_platform").alias("source"), "status",
        F.col("pages_fetched").alias("maps"), F.col("fetched_count").alias("fetched"), F.col("parsed_count").alias("parsed"), F.col("inserted_count").alias("new"), F.col("updated_count").alias("updated"),
        F.col("dup_count").alias("dup"), F.col("error_count").alias("err"), F.round(F.coalesce("missing_ratio", F.lit(0.0)) * 100, 1).cast("double").alias("missing"),
        numbers.seconds_between("started_at", "finished_at", 1).alias("seconds"), F.substring(F.coalesce("error_detail", F.lit("")), 1, 300).alias("detail"))


def alerts(runs: DataFrame, kinds: Sequence[str] = ("schema_drift", "source_failed", "compliance_blocked"), threshold: float = DRIFT) -> DataFrame:
    """One row for each alert a run raises, of the kinds asked for."""
    raised = F.array_compact(F.array(F.when(F.col("missing_ratio") > threshold, "schema_drift"), F.when(F.col("status") == "failed", "source_failed"), F.when(F.col("blocked"), "compliance_blocked")))
    return runs.withColumn("event", F.explode(raised)).filter(F.col("event").isin(*kinds))


def volume_check(counts: DataFrame, day: str, by: str, jump: float = 0.3, dominance: float = 0.8, failing: float = 0.1) -> DataFrame:
    """counts(day, by, n, errors) -> for every day of the calendar between the first and the last, and every group: change against the day
    before, share of the day's rows, share of errors, and the flags of the three. A day on which a group has no row counts as none,
    so it is a drop; after such a day there is no change to give."""
    bounds = counts.agg(F.min(day).alias("first"), F.max(day).alias("last")).filter(F.col("first").isNotNull())
    # one row, the calendar's ends, goes to every group: as many rows come out as there are groups and days
    groups = counts.select(by).distinct().withColumn("_one", F.lit(1)).join(F.broadcast(bounds.withColumn("_one", F.lit(1))), "_one")
    spine = groups.select(by, F.explode(F.sequence("first", "last")).alias(day))
    rows = spine.join(counts, [day, by], "left").select(day, by, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "errors")])
    none = F.lit(0)
    before = F.nullif(F.lag("n").over(Window.partitionBy(by).orderBy(day)), none)
    rows = rows.withColumns({
        "change": F.round((F.col("n") - before) / before, 4), "share": F.round(F.col("n") / F.nullif(F.sum("n").over(Window.partitionBy(day)), none), 4), "error_share": F.round(F.col("errors") / F.nullif(F.col("n"), none), 4),
    })
    flag = lambda c: F.coalesce(c, F.lit(False))
    return rows.withColumns({"jumped": flag(F.abs("change") > jump), "dominant": flag(F.col("share") > dominance), "failing": flag(F.col("error_share") > failing)})


def reconcile(clean: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Fields of the clean rows against an independent reading of the raw texts: key, field, expected, actual of each mismatch.

    Raw texts that say nothing are passed over; a clean NULL against a raw value is a mismatch. These patterns are
    kept apart from the cleaning functions on purpose.
    """
    fields = ["price", "guide", "mileage", "year", "month", "brand"]
    said = _said(raw, key).withColumnsRenamed({f: f"_{f}" for f in fields})
    met = _stored(clean, key).join(said, key)  # whole rows meet: they are told apart by field only where they differ
    wrong = [F.when(F.col(f"_{f}").isNotNull() & ~F.col(f"_{f}").eqNullSafe(F.col(f)), F.struct(F.lit(f).alias("field"), F.col(f"_{f}").alias("expected"), F.col(f).alias("actual"))) for f in fields]
    return met.select(key, F.inline(F.array_compact(F.array(*wrong))))


def _said(raw: DataFrame, key: str) -> DataFrame:
    first = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    yuan = lambda c: F.bround(first(c, r"^([0-9]+)元").try_cast("decimal(12,2)") / 10000, 2)
    shown = lambda c: c.cast("double").cast("string")
    price = F.coalesce(first("price_raw", r"^([0-9.]+)万").try_cast("decimal(12,2)"), yuan("price_raw"))
    km = F.coalesce((first("mileage_raw", r"^([0-9.]+)万").try_cast("double") * 10000).cast("long"), first("mileage_raw", r"^([0-9]+)公里").try_cast("long"))
    return raw.select(key, shown(price).alias("price"), shown(yuan("new_car_price_raw")).alias("guide"), km.cast("string").alias("mileage"), first("reg_date_raw", r"^(\d{4})[年款]").alias("year"),
        first("reg_date_raw", r"^\d{4}年(\d{1,2})月").try_cast("int").cast("string").alias("month"), classify.normalize_brand("brand_raw").alias("brand"))


def _stored(clean: DataFrame, key: str) -> DataFrame:
    shown = lambda c: F.col(c).cast("double").cast("string")
    return clean.select(key, shown("price_wan").alias("price"), shown("new_car_price_wan").alias("guide"), F.col("mileage_km").cast("string").alias("mileage"), F.col("reg_year").cast("string").alias("year"), F.col("reg_month").cast("string").alias("month"), "brand")


def reconcile_counts(clean: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """One row: clean rows checked, those without a raw text, and mismatching fields. key is unique in both."""
    fields = ["price", "guide", "mileage", "year", "month", "brand"]
    said = _said(raw, key).select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    both = _stored(clean, key).join(said, F.col(key) == F.col("_key"), "left")
    wrong = sum((F.when(F.col(f"_{f}").isNotNull() & ~F.col(f"_{f}").eqNullSafe(F.col(f)), 1).otherwise(0) for f in fields), F.lit(0))
    there = F.col("_key").isNotNull()
    return both.agg(F.count_if(there).alias("checked"), F.count_if(~there).alias("missing_raw"), F.sum(F.when(there, wrong).otherwise(0)).alias("mismatches"))


# What a page itself says, read apart from the parser.
PAGE_FACTS = {
    "price_wan": r"full_payment\s*:\s*(\d+)\s*元",
    "new_car_price_wan": r"guide_price\s*:\s*(\d+)\s*元",
    "mileage_km": r"mileage\s*:\s*(\d+)\s*公里",
    "brand": r"(?m)^brand\s*:\s*(\S+)",
    "reg_date": r"first_register\s*:\s*(\d{4}-\d{2})",
}


def page_facts(pages: DataFrame) -> DataFrame:
    """pages(raw_ref, body) -> raw_ref and, for each field of PAGE_FACTS, what the page says of it as text, NULL if it is silent."""
    said = {c: F.nullif(F.regexp_extract("body", p, 1), F.lit("")) for c, p in PAGE_FACTS.items()}
    wan = lambda c: F.bround(said[c].try_cast("decimal(18,0)") / 10_000, 2).cast("decimal(18,2)").cast("string")
    said |= {"price_wan": wan("price_wan"), "new_car_price_wan": wan("new_car_price_wan"), "mileage_km": said["mileage_km"].try_cast("long").cast("string"), "brand": classify.normalize_brand(said["brand"])}
    return pages.select("raw_ref", *[c.alias(name) for name, c in said.items()])


def reconcile_pages(clean: DataFrame, pages: DataFrame) -> DataFrame:
    """Stored rows against the stored pages they came from: line, vehicle_key, raw_ref, kind and, of mismatches, field, expected and actual.

    kind is no_ref (a row names no page), missing_file (the page isn't there), mismatch, or checked: one such row for every row
    whose page was read. What a page doesn't say is passed over; a stored NULL against it is a mismatch. Only what pages say is joined, not
    their text; rows without a page's name don't take part in the join.
    """
    facts = page_facts(pages).withColumnsRenamed({c: f"_{c}" for c in PAGE_FACTS}).withColumn("_there", F.lit(True))
    date = F.when(F.col("reg_year").isNotNull() | F.col("reg_month").isNotNull(), F.concat(F.coalesce(F.col("reg_year").cast("string"), F.lit("?")), F.lit("-"), F.coalesce(F.lpad(F.col("reg_month").cast("string"), 2, "0"), F.lit("?"))))
    stored = {"price_wan": F.col("price_wan").cast("decimal(18,2)").cast("string"), "new_car_price_wan": F.col("new_car_price_wan").cast("decimal(18,2)").cast("string"), "mileage_km": F.col("mileage_km").cast("string"), "brand": F.col("brand"), "reg_date": date}
    rows = clean.select("line", "vehicle_key", F.nullif("raw_ref", F.lit("")).alias("raw_ref"), *[c.alias(name) for name, c in stored.items()])
    named, bare = rows.filter("raw_ref is not null").join(facts, "raw_ref", "left"), rows.filter("raw_ref is null")
    one = lambda kind, field=None, expected=None, actual=None: F.struct(F.lit(kind).alias("kind"), F.lit(field).cast("string").alias("field"), (F.lit(None) if expected is None else F.col(expected)).cast("string").alias("expected"), (F.lit(None) if actual is None else F.col(actual)).cast("string").alias("actual"))
    wrong = [F.when(F.col(f"_{c}").isNotNull() & ~F.col(f"_{c}").eqNullSafe(F.col(c)), one("mismatch", c, f"_{c}", c)) for c in PAGE_FACTS]
    told = F.when(F.col("_there"), F.array_compact(F.array(one("checked"), *wrong))).otherwise(F.array(one("missing_file")))
    found = named.select("line", "vehicle_key", "raw_ref", F.inline(told))
    return found.unionByName(bare.select("line", "vehicle_key", "raw_ref", F.inline(F.array(one("no_ref")))))


def reconcile_page_counts(found: DataFrame) -> DataFrame:
    """One row of reconcile_pages(): checked, mismatches, no_ref, missing_file."""
    kinds = {"checked": "checked", "mismatch": "mismatches", "no_ref": "no_ref", "missing_file": "missing_file"}
    return found.agg(*[F.count_if(F.col("kind") == kind).alias(name) for kind, name in kinds.items()])


def reconcile_page_samples(found: DataFrame, n: int = 20) -> DataFrame:
    """The first n rows that are wrong, by line, key and field."""
    return found.filter(F.col("kind").isin("mismatch", "missing_file")).orderBy("line", "vehicle_key", F.col("field").asc_nulls_first()).limit(n)
