"""Market figures from per-run states: a run adds what it changed, and figures are sums over states.

Every state is a sum of row counts and whole numbers, grouped by the run that last saw the rows. A run adds its rows to its own group, and
takes those it saw again out of the group of the run that saw them before. Rows that are no longer live are whole groups, so they fall away by the
ledger alone. Distinct counts, medians and bounds come from counts by value, which can be taken back exactly; sketches of distinct values or
quantiles can only grow, and vehicles leave.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import market
from .ledger import RunTable

CELL = ["line", "brand", "location_city"]


def _sums() -> dict[str, Column]:
    """What is summed of the rows of a cell, as whole numbers."""
    there = lambda c: F.when(c, 1).otherwise(0)
    whole = lambda c, scale: F.coalesce((F.col(c) * 10**scale).cast("long"), F.lit(0))
    return {
        "n": F.lit(1), "prices": there(F.col("price_wan").isNotNull()), "price": whole("price_wan", 2), "priced": there(F.col("price_wan") != 0),
        "retentions": there(F.col("retention_rate").isNotNull()), "retention": whole("retention_rate", 4), "retained": there(F.col("retention_rate") > 0),
        "mileages": there(F.col("mileage_km").isNotNull()), "mileage": whole("mileage_km", 0),
    }


def _values() -> Column:
    """The values that are counted one by one: price in hundredths, month of registration counted from year 0 (without a month, June)."""
    month = F.col("reg_year") * 12 + F.coalesce("reg_month", F.lit(6))
    one = lambda what, v: F.struct(F.lit(what).alias("what"), v.cast("long").alias("value"))
    return F.filter(F.array(one("price", F.col("price_wan") * 100), one("month", month)), lambda x: x.value.isNotNull())


class MarketStates:
    """The states beside a RunTable. A run's states lie in a folder of their own, written whole before the run counts, so doing a run again
    leaves them as they are; those of a run that broke off are not read."""

    def __init__(self, table: RunTable):
        self.table, self.spark = table, table.spark

    def _path(self) -> str:
        return f"{self.table.path}/states"

    def apply(self, batch: DataFrame, run_id: str) -> dict[str, int]:
        """RunTable.apply(), with the run's states: made of the rows as they lie in the table, so the batch is computed and dealt out once."""
        return self.table.apply(batch, run_id, beside=self._write)

    def _write(self, run_id: str) -> None:
        """One pass: every row that came or went counts in its cell and, one by one, under its values."""
        both = self.table.changed(run_id, [*CELL, "price_wan", "retention_rate", "mileage_km", "reg_year", "reg_month", "_run"])
        signed = lambda sign, c: F.struct(F.lit(sign).alias("sign"), F.col(c).alias("row"))
        rows = both.select(F.inline(F.array(signed(1, "now"), signed(-1, "before")))).filter("row IS NOT NULL").select("sign", "row.*")
        summed = [(F.col("sign") * c).alias(name) for name, c in _sums().items()]
        rows = rows.select("_run", *CELL, "sign", *summed, _values().alias("values")).withColumn("entry", F.explode(F.concat(F.array(F.struct(F.lit("cell").alias("what"), F.lit(0).cast("long").alias("value"))), "values")))
        cell = F.col("entry.what") == "cell"
        by = [F.col("_run"), F.col("line"), *[F.when(cell, F.col(c)).alias(c) for c in CELL[1:]], F.col("entry.what").alias("what"), F.col("entry.value").alias("value")]
        sums = [F.sum(c if c == "n" else F.when(cell, F.col(c))).alias(c) for c in _sums()]
        rows.groupBy(*by).agg(*sums).write.mode("overwrite").parquet(f"{self._path()}/by={run_id}")

    def _live(self, kind: Column, by: Sequence[str], sums: Sequence[str], delete_after: int) -> DataFrame:
        schema = "_run string, line string, brand string, location_city string, what string, value long, " + ", ".join(f"{c} long" for c in _sums())
        fs, at = self.table._at("states")
        if not fs.exists(at):
            return self.spark.createDataFrame([], schema).select(*by, *sums)
        ledger = self.table.ledger()
        done = F.broadcast(ledger.select(F.col("run_id").alias("by")).distinct())  # as many as there are runs, see LEDGER_ROWS
        current = F.broadcast(ledger.filter(F.col("behind") < delete_after).select(F.col("run_id").alias("_run"), "line"))
        states = self.spark.read.schema(schema + ", by string").option("basePath", self._path()).parquet(self._path()).filter(kind)
        rows = states.join(done, "by", "left_semi").join(current, ["_run", "line"], "left_semi")
        return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums]).filter("n > 0")

    def cells(self, delete_after: int = 3) -> DataFrame:
        """line, brand, location_city and the sums of the live rows."""
        return self._live(F.col("what") == "cell", CELL, list(_sums()), delete_after)

    def values(self, delete_after: int = 3) -> DataFrame:
        """line, what, value, n of the live rows."""
        return self._live(F.col("what") != "cell", ["line", "what", "value"], ["n"], delete_after)


def line_scalars(cells: DataFrame, values: DataFrame, as_of: str) -> DataFrame:
    """market.line_scalars() of the live rows."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    sums = cells.groupBy("line").agg(
        F.sum("n").alias("n"), F.countDistinct(filled("brand")).alias("brands"), F.countDistinct(filled("location_city")).alias("cities"), market.mean_of(F.sum("price"), F.sum("prices"), 2, 4).alias("avg_price"),
        market.mean_of(F.sum("retention"), F.sum("retentions"), 4, 4).alias("avg_retention"), market.mean_of(F.sum("mileage"), F.sum("mileages"), 0, 0).cast("long").alias("avg_mileage"))
    age = market.age_years(F.expr("cast((value - 1) div 12 as int)"), F.expr("cast((value - 1) % 12 + 1 as int)"), as_of)
    price, tenths = F.when((F.col("what") == "price") & (F.col("value") != 0), F.col("value")), F.when(F.col("what") == "month", F.round(age * 10).cast("long"))
    spread = values.groupBy("line").agg(
        (F.min(price) / 100).alias("min_price"), (F.max(price) / 100).alias("max_price"), market.mean_of(F.sum(tenths * F.col("n")), F.sum(F.when(tenths.isNotNull(), F.col("n"))), 1, 4).alias("avg_age"))
    return sums.join(spread, "line", "left").select("line", "n", "brands", "cities", "avg_price", "avg_retention", "avg_age", "avg_mileage", "min_price", "max_price")


def upper_median(values: DataFrame) -> DataFrame:
    """market.upper_median(): the first price at which at most half of the rows are still to come. The windows run over distinct prices."""
    prices = values.filter("what = 'price' and value != 0")
    w = Window.partitionBy("line")
    ranked = prices.select("line", "value", F.sum("n").over(w.orderBy("value")).alias("upto"), F.sum("n").over(w).alias("total"))
    return ranked.filter(F.col("upto") > F.expr("total div 2")).groupBy("line").agg((F.min("value") / 100).alias("median_price"))


def price_distribution(values: DataFrame) -> DataFrame:
    """market.distribution() of prices over both lines."""
    counts = values.filter("what = 'price'").groupBy(market.bucket(F.col("value") / 100, market.PRICE_EDGES).alias("label")).agg(F.sum("n").alias("n"))
    return market.labelled(counts, market.PRICE_EDGES)


def brand_price_rank(cells: DataFrame, least: int = 3, n: int = 10) -> DataFrame:
    rows = cells.filter("brand != ''").groupBy("brand").agg(market.mean_of(F.sum("price"), F.sum("priced"), 2, 2).alias("avg_price"), F.sum("priced").alias("n"))
    return rows.filter(F.col("n") >= least).orderBy(F.desc("avg_price"), "brand").limit(n)


def top_counts(cells: DataFrame, column: str, n: int = 10) -> DataFrame:
    known = (F.col(column) != "") & (F.col(column) != market.UNKNOWN)
    return cells.groupBy(column).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last()).limit(n).filter(known).select(F.col(column).alias("name"), "n")
