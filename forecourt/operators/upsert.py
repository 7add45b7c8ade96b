"""Merge of a run into a snapshot, lifecycle of what a run did not see, and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers

STATE = ["captured_at", "last_seen_at", "missing_count", "is_deleted"]


def prepare(clean: DataFrame, run_start) -> DataFrame:
    """A run's rows as they enter the table."""
    at = F.lit(run_start).cast("timestamp") if isinstance(run_start, str) else run_start
    return clean.withColumns({
        "captured_at": at, "last_seen_at": at, "missing_count": F.lit(0), "is_deleted": F.lit(False),
        "retention_rate": numbers.safe_ratio("price_wan", "new_car_price_wan").cast("decimal(8,4)"),
    })


def merge(current: DataFrame, batch: DataFrame, key: str = "vehicle_key", delete_after: int = 3, scope: Sequence[str] = ("line",), ran: bool | None = None) -> DataFrame:
    """current snapshot and prepared batch (one row a key each) -> new snapshot with ``action``: insert, update, keep, delete.

    Rows of the batch replace those of the snapshot. Every other row has been missed once more, and is marked
    deleted from ``delete_after`` on, if the batch holds a row with the same values of ``scope``: a run of one line leaves the other as it is.
    Without a scope every row not seen is aged.
    An empty batch changes nothing; whether it is empty is asked of the batch unless the caller says so (``ran``). One full outer
    join on the key, both sides hash-partitioned alike; a column that nobody reads of the result goes through neither side's shuffle.
    """
    names = current.columns
    old = current.select(F.col(key).alias("_k"), F.lit(True).alias("_had"), *[F.col(c).alias(f"_old_{c}") for c in names])
    new = batch.select(F.col(key).alias("_k"), F.lit(True).alias("_has"), *[F.col(c).alias(f"_new_{c}") for c in names])
    both = old.join(new, "_k", "full_outer")
    if scope:
        seen = batch.select(*(F.col(c).alias(f"_seen_{c}") for c in scope), F.lit(True).alias("_run")).distinct()
        both = both.join(seen, [F.col(f"_old_{c}").eqNullSafe(F.col(f"_seen_{c}")) for c in scope], "left")
    else:
        both = both.withColumn("_run", F.lit(not batch.isEmpty() if ran is None else ran))
    ran_here, deleted = F.coalesce(F.col("_run"), F.lit(False)), F.col("_old_is_deleted")
    missed = F.col("_old_missing_count") + F.when(F.col("_run"), 1).otherwise(0)
    kept = {"missing_count": missed.cast("int"), "is_deleted": deleted | (ran_here & (missed >= delete_after))}
    action = F.when(F.col("_had").isNull(), "insert").when(F.col("_has").isNotNull(), "update").when(~deleted & ran_here & (missed >= delete_after), "delete").otherwise("keep")
    return both.select(*[F.when(F.col("_has").isNotNull(), F.col(f"_new_{c}")).otherwise(kept.get(c, F.col(f"_old_{c}"))).alias(c) for c in names], action.alias("action"))


def split_upsert(batch: DataFrame, current: DataFrame, key: str = "vehicle_key") -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows to update)."""
    return batch.join(current.select(key), key, "left_anti"), batch.join(current.select(key), key, "left_semi")


RUN_LOG = ("run_id string, business_line string, source_platform string, task_type string, status string, pages_fetched int, fetched_count int, parsed_count int, inserted_count int, updated_count int, dup_count int, "
    "error_count int, missing_ratio decimal(6,4), error_detail string, started_at timestamp, finished_at timestamp")  # fmt: skip


def append_run_log(rows: DataFrame, path: str) -> None:
    """The log's columns only, in its types; those that rows lack are NULL; error_detail is cut to 2000 characters."""
    columns = [c.strip().rsplit(" ", 1) for c in RUN_LOG.replace("decimal(6,4)", "decimal(6;4)").split(",")]
    columns = [(c, t.replace(";", ",")) for c, t in columns]
    value = lambda c: F.substring(c, 1, 2000) if c == "error_detail" else F.col(c)
    rows.select(*[(value(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns]).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def recent_runs(log: DataFrame, n: int = 20) -> DataFrame:
    """The newest runs first."""
    return log.orderBy(F.desc("started_at"), "source_platform").limit(n)
