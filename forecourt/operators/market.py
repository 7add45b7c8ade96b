"""Market statistics over the listing table. Every function is one lazy DataFrame; groups are pre-aggregated by Catalyst,
nothing is collected, ties in rankings go by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import UNKNOWN
from ..functions.numbers import age_years, bucket

# Edges and labels.
PRICE_EDGES = ((0, 3, "3万以下"), (3, 5, "3-5万"), (5, 8, "5-8万"), (8, 12, "8-12万"), (12, 18, "12-18万"), (18, 25, "18-25万"), (25, 40, "25-40万"), (40, 1e9, "40万以上"))
AGE_EDGES = ((0, 1, "1年内"), (1, 2, "1-2年"), (2, 3, "2-3年"), (3, 5, "3-5年"), (5, 8, "5-8年"), (8, 11, "8-11年"), (11, 99, "11年以上"))
MILEAGE_EDGES = ((0, 10_000, "1万内"), (10_000, 30_000, "1-3万"), (30_000, 60_000, "3-6万"), (60_000, 100_000, "6-10万"), (100_000, 150_000, "10-15万"), (150_000, 1e9, "15万以上"))
SOH_EDGES = ((0, 80, "<80%"), (80, 85, "80-85%"), (85, 90, "85-90%"), (90, 95, "90-95%"), (95, 101, "95%+"))
LITRE_EDGES = ((0, 1.0, "1.0L以下"), (1.0, 1.6, "1.0-1.6L"), (1.6, 2.0, "1.6-2.0L"), (2.0, 3.0, "2.0-3.0L"), (3.0, 10, "3.0L以上"))


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _quotient(a: Column, b: Column) -> Column:
    """Whole part of a / b for whole decimals from 0 on."""
    return (a - a % b) / b


def mean(c: Column | str, scale: int, digits: int = 4) -> Column:
    """The mean of values from 0 on with ``scale`` decimals, rounded half up to ``digits``. Sums and the division are of whole
    numbers, so the result doesn't depend on the order of the rows; NULL without a value."""
    c = F.col(c) if isinstance(c, str) else c
    return mean_of(F.sum(F.round(c.cast(f"decimal(18,{scale})") * 10**scale).cast("decimal(18,0)")), F.count(c), scale, digits)


def mean_of(total: Column, n: Column, scale: int, digits: int) -> Column:
    """mean() from the sum of the values times 10**scale and their number; NULL for none."""
    n = F.nullif(n, F.lit(0))
    whole = lambda x: x.cast("decimal(38,0)")
    up, down = 10 ** max(digits - scale, 0), 10 ** max(scale - digits, 0)
    return (_quotient(whole(total * 2 * up + n * down), whole(n * 2 * down)) / 10**digits).cast("double")


def priced() -> Column:
    """Price as a double, a zero as NULL."""
    return F.nullif(_d("price_wan"), F.lit(0.0))


def line_stats(table: DataFrame) -> DataFrame:
    """One row a line: counts of all, live and deleted rows; price and retention of the live ones."""
    live = ~F.col("is_deleted")
    of = lambda c: F.when(live, _d(c))
    return table.groupBy("line").agg(F.count("*").alias("total"), F.count_if(live).alias("active"), F.count_if(~live).alias("deleted"), mean(of("price_wan"), 2, 2).alias("avg_price"), F.min(of("price_wan")).alias("min_price"), F.max(of("price_wan")).alias("max_price"), mean(of("retention_rate"), 4).alias("avg_retention"))


def platform_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("line", "source_platform").agg(F.count("*").alias("n")).orderBy("line", F.desc("n"), "source_platform")


def last_runs(log: DataFrame) -> DataFrame:
    return log.groupBy("line").agg(F.max_by("status", "started_at").alias("last_status"), F.max("started_at").alias("last_started"))


def line_scalars(table: DataFrame, as_of: str, exact: bool = True) -> DataFrame:
    """exact=False counts brands and cities by sketches."""
    distinct = F.countDistinct if exact else F.approx_count_distinct
    return table.groupBy("line").agg(
        F.count("*").alias("n"), distinct(_filled("brand")).alias("brands"), distinct(_filled("location_city")).alias("cities"), mean("price_wan", 2).alias("avg_price"), mean("retention_rate", 4).alias("avg_retention"),
        mean(age_years("reg_year", "reg_month", as_of), 1).alias("avg_age"), mean("mileage_km", 0, 0).cast("long").alias("avg_mileage"), F.min(priced()).alias("min_price"), F.max(priced()).alias("max_price"))


def upper_median(table: DataFrame, exact: bool = True) -> DataFrame:
    """The upper median of prices that are not zero; exact=False by a sketch."""
    value = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY p DESC)") if exact else F.percentile_approx("p", 0.5)
    return table.select("line", priced().alias("p")).filter("p is not null").groupBy("line").agg(value.alias("median_price"))


def top_counts(table: DataFrame, column: str, n: int = 10, strict: bool = False) -> DataFrame:
    """The n most frequent values; missing and unknown ones are taken out after the cut (strict: before)."""
    known = (F.col(column) != "") & (F.col(column) != UNKNOWN)
    rows = table.filter(known) if strict else table
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last()).limit(n).filter(known).select(F.col(column).alias("name"), "n")


def distribution(table: DataFrame, value: Column, edges: Sequence[tuple[float, float, str]]) -> DataFrame:
    """Every label with its count, zeros included, numbered in order of the edges."""
    return labelled(table.groupBy(bucket(value, edges).alias("label")).agg(F.count("*").alias("n")), edges)


def labelled(counts: DataFrame, edges: Sequence[tuple[float, float, str]]) -> DataFrame:
    """counts(label, n) with a row for every label."""
    labels = counts.sparkSession.createDataFrame([(i, e[2]) for i, e in enumerate(edges)], "place int, label string")
    return labels.join(counts, "label", "left").select("place", "label", F.coalesce("n", F.lit(0)).alias("n"))


def brand_price_rank(table: DataFrame, least: int = 3, n: int = 10) -> DataFrame:
    rows = table.select("brand", priced().alias("p")).filter("brand is not null and brand != '' and p is not null")
    return rows.groupBy("brand").agg(mean("p", 2, 2).alias("avg_price"), F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("avg_price"), "brand").limit(n)


def brand_retention_rank(table: DataFrame, least: int = 2, n: int = 10) -> DataFrame:
    rows = table.filter("brand is not null and brand != '' and retention_rate > 0")
    return rows.groupBy("brand").agg(mean(F.col("retention_rate") * 100, 2, 1).alias("retention_pct"), F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("retention_pct"), "brand").limit(n)


def age_mileage_heat(table: DataFrame, as_of: str) -> DataFrame:
    cells = table.select(bucket(age_years("reg_year", "reg_month", as_of), AGE_EDGES).alias("age_bucket"), bucket("mileage_km", MILEAGE_EDGES).alias("mileage_bucket"))
    return cells.filter("age_bucket is not null and mileage_bucket is not null").groupBy("age_bucket", "mileage_bucket").agg(F.count("*").alias("n"))


def age_retention(table: DataFrame, as_of: str) -> DataFrame:
    """Retention by whole years of age, 12 and more together."""
    rows = table.select(F.least(age_years("reg_year", "reg_month", as_of).cast("int"), F.lit(12)).alias("age"), (F.col("retention_rate") * 100).alias("r")).filter("age is not null and r is not null")
    return rows.groupBy("age").agg(mean("r", 2, 1).alias("retention_pct"), F.count("*").alias("n"))


def field_completeness(table: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Percent of rows with a value, by field: one pass over all fields, then turned; no rows: 0."""
    share = lambda c: F.coalesce(F.round(F.avg(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 100.0).otherwise(0.0)), 1), F.lit(0.0)).alias(c)
    return table.agg(*map(share, fields)).unpivot([], list(fields), "field", "filled_pct")


def price_by_class(table: DataFrame, column: str) -> DataFrame:
    """Count and average of prices that are not zero by class, a missing class as unknown."""
    return table.filter(priced().isNotNull()).groupBy(F.coalesce(F.col(column), F.lit(UNKNOWN)).alias("name")).agg(F.count("*").alias("n"), mean("price_wan", 2, 2).alias("avg_price"))


def class_counts(table: DataFrame, column: str) -> DataFrame:
    return table.filter((F.col(column) != "") & (F.col(column) != UNKNOWN)).groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))


def range_price_points(ev: DataFrame) -> DataFrame:
    return ev.filter("range_km is not null and price_wan is not null").select("vehicle_key", "range_km", _d("price_wan").alias("price"), "brand", "model")


def mean_and_count(table: DataFrame, column: str, scale: int, digits: int) -> DataFrame:
    return table.agg(mean(column, scale, digits).alias("avg"), F.count(column).alias("n"))


def line_compare(table: DataFrame, as_of: str) -> DataFrame:
    """The lines and both together, side by side."""
    rows = table.select("line", "price_wan", "retention_rate", "mileage_km", age_years("reg_year", "reg_month", as_of).alias("age"), _filled("brand").alias("brand"), _filled("location_city").alias("city"))
    return rows.groupingSets([["line"], []], "line").agg(
        F.count("*").alias("n"), mean("price_wan", 2).alias("avg_price"), mean("retention_rate", 4).alias("avg_retention"), mean("age", 1).alias("avg_age"), mean("mileage_km", 0, 1).alias("avg_mileage"),
        F.countDistinct("brand").alias("brands"), F.countDistinct("city").alias("cities")).withColumn("line", F.coalesce("line", F.lit("all")))


def cross_source_gap(table: DataFrame, n: int = 20) -> DataFrame:
    """Live vehicles offered on several platforms, the widest price gaps first."""
    rows = table.filter("match_key is not null and not is_deleted").groupBy("match_key").agg(F.countDistinct("source_platform").alias("platforms"), F.min(_d("price_wan")).alias("low"), F.max(_d("price_wan")).alias("high"))
    return rows.filter("platforms > 1").withColumn("gap", F.round(F.col("high") - F.col("low"), 2)).orderBy(F.desc("gap"), "match_key").limit(n)


def same_vehicle_pairs(table: DataFrame) -> DataFrame:
    """Listings of one match_key on two platforms, lower platform first: a reading list for one vehicle, not a dedupe; AQE splits
    the key of a very common vehicle. Use cross_source_gap() for figures."""
    one = table.filter("match_key is not null").groupBy("match_key", "source_platform").agg(F.min(_d("price_wan")).alias("low"), F.count("*").alias("n"))
    a, b = one.alias("a"), one.alias("b")
    return a.join(b, (F.col("a.match_key") == F.col("b.match_key")) & (F.col("a.source_platform") < F.col("b.source_platform"))).select("a.match_key", F.col("a.source_platform").alias("platform_a"), F.col("b.source_platform").alias("platform_b"), F.col("a.low").alias("low_a"), F.col("b.low").alias("low_b"), (F.col("a.n") * F.col("b.n")).alias("pairs"))


def recent_averages(table: DataFrame, as_of: str, days: int = 30, brand: str | None = None) -> DataFrame:
    """Live rows of the last days, of one brand or of all, by brand and model."""
    recent = table.filter(~F.col("is_deleted") & (F.col("captured_at") >= F.to_timestamp(F.lit(as_of)) - F.expr(f"INTERVAL {days} DAYS")))
    if brand is not None:
        recent = recent.filter(F.col("brand") == brand)
    return recent.groupBy("brand", "model").agg(F.count("*").alias("n"), mean("price_wan", 2, 2).alias("avg_price"))


def battery_range_bands(ev: DataFrame) -> DataFrame:
    """Live rows by battery and range; a missing range is in the last band."""
    band = F.when(F.col("range_km") < 400, "<400").when(F.col("range_km") < 600, "400-600").otherwise("600+")
    return ev.filter(~F.col("is_deleted")).groupBy("battery_type", band.alias("band")).agg(F.count("*").alias("n"), mean("price_wan", 2, 2).alias("avg_price"), mean("retention_rate", 4).alias("avg_retention"))


def duplicate_ids(table: DataFrame) -> DataFrame:
    return table.groupBy("source_id").agg(F.count("*").alias("n")).filter("n > 1")
