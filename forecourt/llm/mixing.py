"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

A document's place is a 48-bit hash of its id and text. Per source, words are summed by hash bucket
(12 bits a level); the bucket in which the budget runs out is split into 4096 finer ones, three times
over, which gives a threshold on the first 36 bits. Documents below it are taken: no sort, and budgets nest
(a larger budget takes all that a smaller one takes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

LEVELS, BITS, HASH_BITS = 3, 12, 48
#: Up to this many sources, one threshold row for each is broadcast (some 50 bytes a row); beyond, a salted join.
BROADCAST_SOURCES = 50_000
SALTS = 64


def _prefix(level: int) -> Column:
    return F.shiftright("h", HASH_BITS - BITS * level)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """sizes(source, source_size) -> with target. Sources in code-point order, null last, weigh ``weights``
    repeating and share ``share`` times all words by weight; none gets over ``cap`` times its own words, the
    excess is shared again by weight. One row a source: the windows hold the list of sources, nothing else.

    Filling in order of cap * size / weight, the level that a source would see if all before it were full
    first rises and then falls; its largest value is the water level.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    fill = Window.orderBy("fills_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(fill), F.lit(0))
    ranked = sizes.withColumn("place", F.row_number().over(place) - 1).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("fills_at", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - before("source_size") * F.lit(float(cap))
    ranked = ranked.withColumn("level", left / (F.sum("weight").over(whole) - before("weight")))
    return ranked.select("source", "source_size", F.least(F.col("source_size") * F.lit(float(cap)), F.max("level").over(whole) * F.col("weight")).alias("target"))


def _place() -> Column:
    identity = F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(identity, 1, HASH_BITS // 4), 16, 10).cast("long")


def _thresholds(slim: DataFrame, weights: Sequence[float], share: float, cap: float) -> tuple[DataFrame, bool]:
    """source, source_size, target, passes, cut of each source of slim(source, size, h); whether they are few enough to broadcast."""
    hist = materialize(slim.groupBy("source", _prefix(1).alias("cell")).agg(F.sum("size").alias("size")), "mix-hist")
    targets = source_targets(hist.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = materialize(targets.withColumn("passes", passes.cast("int")).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")
    few = state.count() <= BROADCAST_SOURCES
    small = F.broadcast if few else lambda df: df
    cells, edge = hist, state.select("source", "rest", F.lit(0.0).alias("base"))
    for level in range(1, LEVELS + 1):
        if level > 1:
            inside = slim.withColumn("up", _prefix(level - 1)).alias("d").join(small(edge.alias("e")), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.up") == F.col("e.cell")))
            cells = inside.groupBy(F.col("d.source").alias("source"), _prefix(level).alias("cell")).agg(F.sum("d.size").alias("size"))
        run = Window.partitionBy("c.source").orderBy("c.cell")  # 4096 rows a source at most
        sums = cells.alias("c").join(small(edge.select("source", "rest", "base").alias("e")), F.col("c.source").eqNullSafe(F.col("e.source"))).select("c.source", "c.cell", "rest", "size", (F.col("base") + F.sum("size").over(run)).alias("upto"))
        at = F.struct("cell", "upto", "size")
        edge = sums.filter("rest > 0 and upto >= rest").groupBy("source", "rest").agg(F.min(at).alias("at")).select("source", "rest", "at.cell", "at.upto", (F.col("at.upto") - F.col("at.size")).alias("base"))
        edge = materialize(edge, "mix-edge")
    nearer = F.col("upto") - F.col("e.rest") <= F.col("e.rest") - F.col("base")
    cut = F.coalesce(F.col("cell") + F.when(nearer, 1).otherwise(0), F.lit(0))
    state = state.alias("s").join(small(edge.alias("e")), F.col("s.source").eqNullSafe(F.col("e.source")), "left").select("s.source", "source_size", "target", "passes", cut.alias("cut"))
    return state, few


def _with_thresholds(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """rows(source, h, ...) joined with their source's threshold, as s; copies from the two."""
    on = F.col("d.source").eqNullSafe(F.col("s.source"))
    if few:
        joined = rows.alias("d").join(F.broadcast(state.alias("s")), on)
    else:
        state = state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod("h", F.lit(SALTS))).alias("d").join(state.alias("s"), on & (F.col("d.salt") == F.col("s.salt")))
    return joined.withColumn("copies", (F.col("passes") + F.when(_prefix(LEVELS) < F.col("cut"), 1).otherwise(0)).cast("int"))


def _slim(docs: DataFrame) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), _place().alias("h")), "mix-sizes")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """docs(doc_id, text, source, ...) -> doc_id, size, source_size, target, copies, taken, h.

    size counts the words of the whole text; copies is how often the mix takes the document (0 up to the
    least whole number >= cap) and taken = copies * size. Whole passes come first, the rest of the target by
    threshold; the last hash cell is taken if that comes nearer to the target.

    Null text: size 0. Null source: a source of its own, last in order. Null doc_id: hashed as empty text.
    Repeated rows have one hash and are taken together. A source without words has target 0. An empty table
    gives no rows. Other columns are ignored, whatever their names. The list of sources (one row each) passes one task; a document
    that is most of its source can't be taken in part, and neither can the repeats of one row: then the mix is as near as it gets.
    """
    slim = _slim(docs)
    joined = _with_thresholds(slim, *_thresholds(slim, weights, share, cap))
    return joined.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "h")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The documents that mix_sources() takes: all columns of docs (one named copies is replaced), then copies, how often."""
    names = [c for c in docs.columns if c != "copies"]
    state, few = _thresholds(_slim(docs), weights, share, cap)
    rows = docs.select(F.struct(*names).alias("row"), F.col("source").cast("string").alias("source"), _place().alias("h"))
    taken = _with_thresholds(rows, state, few).filter("copies > 0")
    return taken.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "copies")


def op2_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 9))::BIGINT AS cell
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM p),
f AS (SELECT *, source_size * 2.0::DOUBLE / weight AS fills_at FROM w),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - CAST(coalesce(sum(source_size) OVER fill, 0) AS DOUBLE) * 2.0::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0)) AS level
      FROM f WINDOW fill AS (ORDER BY fills_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, max(level) OVER () * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
c AS (SELECT source, cell, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source, cell),
u AS (SELECT c.source, c.cell, c.size, sum(c.size) OVER (PARTITION BY c.source ORDER BY c.cell) AS upto, r.target - r.passes * r.source_size AS rest
      FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source),
e AS (SELECT source, arg_min(cell, cell) AS cell, arg_min(upto, cell) AS upto, arg_min(size, cell) AS size, any_value(rest) AS rest
      FROM u WHERE rest > 0 AND upto >= rest GROUP BY source),
k AS (SELECT source, cell + CASE WHEN upto - rest <= rest - (upto - size) THEN 1 ELSE 0 END AS cut FROM e)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, r.source_size, r.target,
       CAST((r.passes + CASE WHEN d.cell < coalesce(k.cut, 0) THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""
