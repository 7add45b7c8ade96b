"""Continuous forms of the batch jobs: replay into snapshots, dedupe, drift by window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ledger, normalize, upsert


def replay(raw: DataFrame, table: ledger.RunTable, checkpoint: str, as_of: str, order: Sequence[str]) -> StreamingQuery:
    """Raw listings as they come -> runs of the listing table. Each micro-batch is cleaned, validated and deduplicated, and its rows are
    written under its own run id, so a batch done again after a failure changes nothing. Rows of the lines that a batch holds age by batch."""

    def step(batch: DataFrame, number: int) -> None:
        cores = batch.sparkSession.sparkContext.defaultParallelism
        if batch.rdd.getNumPartitions() < cores:  # a few new files: deal their rows out
            batch = batch.repartition(cores)
        clean = normalize.accepted(normalize.validate(normalize.normalize(batch, as_of, keep=list(order))))
        table.apply(upsert.prepare(normalize.dedupe_last(clean, "vehicle_key", order), F.col("fetched_at")), f"batch{number:09d}")

    return raw.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_rows(rows: DataFrame, key: str, at: str, order: Sequence[str], gap: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """The first row of each run of repeats: rows of a key of which each comes at most ``gap`` after the one before. With ``repeats``, how many
    rows the run has, and ``until``, its last row's time plus the gap.

    First is the earliest by time, then by ``order``, whatever order rows arrive in. A run is told once the watermark (``delay`` behind the newest
    row) has passed its end, and then its state goes; rows later than the watermark are left out. State is one row a key and open run, whatever
    the stream's length. Rows without a key are left out.
    """
    timed = rows.filter(F.col(key).isNotNull()).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    rest = [c for c in rows.columns if c not in (at, *order)]
    found = timed.groupBy(F.session_window(at, gap).alias("run"), key).agg(F.min(F.struct(at, *order, *rest)).alias("first"), F.count("*").alias("repeats"))
    return found.select("first.*", "repeats", F.col("run.end").alias("until"))


def drift(rows: DataFrame, fields: Sequence[str], by: str, at: str, window: str = "1 hour", delay: str = "2 hours", threshold: float = 0.3) -> DataFrame:
    """Missing shares of raw fields by window and source, with the fields that drift."""
    share = lambda c: F.round(F.avg(F.when(F.col(c).isNull() | (F.col(c) == ""), 1.0).otherwise(0.0)), 4)
    shares = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).groupBy(F.window(at, window), by).agg(F.count("*").alias("n"), *[share(c).alias(c) for c in fields])
    drifting = F.array_compact(F.array(*[F.when(F.col(c) > threshold, F.lit(c)) for c in fields]))
    return shares.select(F.col("window.start").alias("start"), by, "n", *fields, F.array_join(drifting, ",").alias("drifting"))


def write_each(stream: DataFrame, path: Callable[[int], str], checkpoint: str, mode: str) -> StreamingQuery:
    """Every micro-batch whole under its own path (complete mode: the last one holds everything)."""
    return stream.writeStream.outputMode(mode).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(path(n))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
