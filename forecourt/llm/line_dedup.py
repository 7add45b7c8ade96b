"""Line dedup over levelled sorted runs of line hashes.

A run is a Parquet table of (key, owner), dealt by key and sorted within its files. A new batch is
anti-joined with the runs by merge; what is new becomes a run of level 0. When a level holds ``fanout`` runs they
are merged into one run of the next level, so the number of runs read for a batch grows with the logarithm of the
number of batches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import BLANKS, ascii_lower, materialize, new_path, text_or_empty

RUN = "key binary, owner long"
#: Stands for a null doc_id: such rows count as one document that comes last.
LAST = 2**63 - 1


class LineRuns:
    """The store of line keys seen so far: ``levels[i]`` lists the paths of the runs of level i.

    Every run is written in full before it is listed, and merged runs are only then dropped from the list, so a
    job that dies leaves a readable store.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2, levels: list[list[str]] | None = None):
        self.spark, self.fanout, self.levels = spark, fanout, levels or []

    def read(self) -> DataFrame:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.schema(RUN).parquet(*paths) if paths else self.spark.createDataFrame([], RUN)

    def _write(self, rows: DataFrame, level: int) -> None:
        path = new_path(self.spark, f"line-run-level{level}")
        rows.select("key", "owner").sortWithinPartitions("key").write.option("compression", "none").parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, rows: DataFrame) -> None:
        """rows(key, owner): keys that no run holds yet."""
        self._write(rows, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self.levels[level]
            self._write(self.spark.read.schema(RUN).parquet(*merged).repartition("key"), level + 1)
            self.levels[level] = [p for p in self.levels[level] if p not in merged]
            level += 1


def _lines(batch: DataFrame, least: int) -> DataFrame:
    """doc, mark, pos, key of the lines long enough to count; a key is the MD5 of the stripped, lower-cased line."""
    lines = batch.select("doc", "mark", F.posexplode(F.split(text_or_empty("row.text"), "\n", -1)).alias("pos", "line"))
    bare = lines.select("doc", "mark", "pos", F.btrim("line", F.lit(BLANKS)).alias("bare")).filter(F.char_length("bare") >= least)
    return bare.select("doc", "mark", "pos", F.unhex(F.md5(ascii_lower(F.col("bare")).cast("binary"))).alias("key"))


@F.pandas_udf(StringType())
def _without(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    def kept(text, at):
        if at is None:
            return text
        lines, gone = text.split("\n"), set(at.tolist())
        return "\n".join(line for i, line in enumerate(lines) if i not in gone)

    return pd.Series([kept(*x) for x in zip(texts, dropped)], dtype=object)


def dedup_batch(docs: DataFrame, runs: LineRuns, least: int = 10) -> DataFrame:
    """Cleans one batch against all earlier ones and adds its own keys to the runs.

    Returns the columns of docs, text without the dropped lines, then n_lines and n_dropped (columns of these
    names in docs are replaced). A line is dropped if an earlier batch, or a smaller doc_id of this one, holds its key.

    Null or empty text is one empty line and comes back as empty text. Rows of one doc_id are one document: it
    keeps all its repeats of a line. Null ids count as one document that comes last. Lines under ``least`` code
    points always stay. Extra columns pass through whatever their names.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    batch = docs.select(F.struct(*names).alias("row")).select("row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_or_empty("row.text")).alias("mark"))
    lines = materialize(_lines(batch, least), "line-keys", "none")
    first = lines.groupBy("key").agg(F.min("doc").alias("owner"), (F.min("doc") < F.max("doc")).alias("many"))
    seen = runs.read().select("key", F.lit(True).alias("seen"))
    first = materialize(first.join(seen.hint("merge"), "key", "left"), "line-owners", "none")
    runs.add(first.filter("seen is null"))  # its files are parts by key already
    shared = first.filter("many or seen").select("key", F.when(F.col("seen"), -1 - LAST).otherwise(F.col("owner")).alias("owner"))
    gone = lines.join(shared.hint("merge"), "key").filter("owner < doc").groupBy("doc", "mark").agg(F.collect_set("pos").alias("dropped"))
    kept = batch.join(gone, ["doc", "mark"], "left")
    text = _without(text_or_empty("row.text"), F.col("dropped"))
    columns = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names]
    n_lines = F.regexp_count(text_or_empty("row.text"), F.lit("\n")) + 1
    return kept.select(*columns, n_lines.cast("long").alias("n_lines"), F.greatest(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 2, least: int = 10) -> DataFrame:
    """dedup_batch() over ``batches`` ranges of doc_id, smallest ids first, so that the smallest doc_id holding a
    line keeps it. An empty table gives no rows."""
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    runs, parts = LineRuns(docs.sparkSession, fanout), []
    bounds = [None, *sorted(set(cuts)), None]
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    for low, high in zip(bounds, bounds[1:]):
        part = docs if low is None else docs.filter(doc > low)
        parts.append(dedup_batch(part if high is None else part.filter(doc <= high), runs, least))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def op10_line_dedup(spark, sf_dir):
    cleaned = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT k.*, coalesce(o.owner < k.doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""
