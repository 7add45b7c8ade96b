"""Near-duplicate classes by BagMinHash over five-word shingles with multiplicities.

Signature: every shingle with weight w carries Poisson points on the weight axis up to w. The axis is discretised to
whole numbers and cut into (0,1], (1,2], (2,4], (4,8] ...; a part's first point comes from a generator seeded by
shingle and part, then the part is halved: one half keeps the point, the other draws its own later one. So only points
before the current maximum of a signature are ever made, and texts with different weights of a shingle see
the same points. Component k of the signature is the first point that fell to k; two signatures agree in a component
with the probability of the weighted Jaccard similarity.

Classes: equal bags are one vertex. Vertices are banded; in each bucket the others are verified (exact multiset overlap)
against the vertex that meets most others, which in a group of copies lies near its middle. Where a bucket's vertices are still of
several components, every vertex outside the bucket's largest component is then compared with all vertices of other
components. A pair within one component can't change the classes and is never made, so copies aren't expanded into pairs;
nor is a pair that sizes and item sketches (one bit for each of SKETCH cells that an item hashes to: a bit that one side
has alone is an item that the other side lacks) prove to be under the threshold. No link between texts that share a
bucket is lost.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, in_slices, materialize, text_or_empty
from .shingles import bags, mix, shingle_hashes, word_hashes

BANDS, ROWS = 20, 6
#: Id sets up to this many rows (16 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Bits of an item sketch.
SKETCH = 2048
#: Rows of one key that a task joins at most, about: a key with more is dealt out over several.
SPLIT = 4096
LAST = 2**63 - 1
_U = np.uint64


def _draw(element: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Point number ``count`` of a part's process: distance from the one before, component."""
    with np.errstate(over="ignore"):
        seed = mix(element + mix(low.astype(np.uint64) * _U(0x8CB92BA72F3D8DD7) + high.astype(np.uint64)) + count.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        step = -np.log(((seed >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (high - low)
        return step, (mix(seed ^ _U(0xA0761D6478BD642F)) % _U(parts)).astype(np.int64)


def bag_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, parts: int = BANDS * ROWS) -> np.ndarray:
    """Signatures (texts x parts) of bags given as (owner, element, weight >= 1). Empty bags: all infinite."""
    least = np.full((texts, parts), np.inf)
    # the parts of the weight axis that begin below the weight
    top = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    level = np.arange(int(top.sum())) - np.repeat(np.cumsum(top) - top, top)
    owner, element, weight = np.repeat(owner, top), np.repeat(element, top), np.repeat(weight, top)
    low, high = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)), 1 << level
    count = np.zeros(len(owner), np.int64)
    at, part = _draw(element, low, high, count, parts)
    while len(owner):
        full = high <= weight
        np.minimum.at(least, (owner[full], part[full]), at[full])
        live = at < least.max(axis=1)[owner]
        owner, element, weight, low, high, count, at, part = (x[live] for x in (owner, element, weight, low, high, count, at, part))
        leaf = high - low == 1
        step, other = _draw(element[leaf], low[leaf], high[leaf], count[leaf] + 1, parts)
        grown = [(owner[leaf], element[leaf], weight[leaf], low[leaf], high[leaf], count[leaf] + 1, at[leaf] + step, other)]
        if not leaf.all():
            o, e, w, lo, hi, _, x, p = (v[~leaf] for v in (owner, element, weight, low, high, count, at, part))
            mid = (lo + hi) // 2
            with np.errstate(over="ignore"):
                keeps_left = mix(e ^ mix(lo.astype(np.uint64) * _U(0xE7037ED1A0B428DB) + hi.astype(np.uint64))) >> _U(63) == 0
            for left, a, b in ((True, lo, mid), (False, mid, hi)):
                zero = np.zeros(len(o), np.int64)
                step, fresh = _draw(e, a, b, zero, parts)
                mine, some = keeps_left == left, a < w
                grown.append(tuple(v[some] for v in (o, e, w, a, b, zero, np.where(mine, x, x + step), np.where(mine, p, fresh))))
        owner, element, weight, low, high, count, at, part = (np.concatenate(v) for v in zip(*grown))
        live = at < least.max(axis=1)[owner]
        owner, element, weight, low, high, count, at, part = (x[live] for x in (owner, element, weight, low, high, count, at, part))
    return least


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(texts x bands) keys; the last bits of a value don't count, so that machines may differ in rounding."""
    bits = mix(signatures.view(np.uint64) >> _U(20))
    keys = np.zeros((len(bits), bits.shape[1] // rows), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            keys = mix(keys * _U(0x9E3779B97F4A7C15) + bits[:, r::rows][:, : keys.shape[1]])
        return mix(keys + np.arange(1, keys.shape[1] + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([t.as_buffer().to_pybytes() for t in column])


def _digests(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int) -> list[bytes]:
    at = np.searchsorted(owner, np.arange(texts + 1))
    return [hashlib.md5(hashes[a:b].tobytes() + weight[a:b].tobytes()).digest() for a, b in zip(at, at[1:])]


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = 5) -> DataFrame:
    """docs(doc_id, text, ...) -> doc, copy (hash of the text), bag (digest of the multiset of shingles), size (shingles), bands (array; empty for empty bags)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, counts = _words(batch.column(1))
        owner, hashes, weight, _ = bags(*shingle_hashes(words, counts, shingle))
        sizes = np.bincount(owner, weight, minlength=len(batch)).astype(np.int64)
        found = band_keys(bag_minhash(owner, hashes, weight, len(batch), bands * rows), rows).view(np.int64)
        keys = [k if n else k[:0] for k, n in zip(found, counts)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_digests(owner, hashes, weight, len(batch)), pa.binary()), pa.array(sizes), pa.array(keys, pa.list_(pa.int64()))], ["doc", "copy", "bag", "size", "bands"])

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    return docs.select(doc, text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("copy")).mapInArrow(in_slices(step, 1), "doc long, copy long, bag binary, size long, bands array<long>")


def _item_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """docs(text) -> bag, items, bits: the multiset as a set, each occurrence hashed with its number among equals, and its sketch."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, hashes, weight, number = bags(*shingle_hashes(*_words(batch.column(0)), shingle))
        digests = _digests(owner, hashes, weight, len(batch))
        with np.errstate(over="ignore"):
            each = mix(np.repeat(hashes, weight) + number.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        owner, cell = np.repeat(owner, weight), (each % _U(SKETCH)).astype(np.int64)
        sketch = np.zeros(len(batch) * SKETCH // 64, np.uint64)
        np.bitwise_or.at(sketch, owner * (SKETCH // 64) + cell // 64, _U(1) << (cell % 64).astype(np.uint64))
        at = np.searchsorted(owner, np.arange(len(batch) + 1))
        items = [each[x:y].view(np.int64) for x, y in zip(at, at[1:])]
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(items, pa.list_(pa.int64())), pa.array(list(sketch.view(np.int64).reshape(len(batch), -1)), pa.list_(pa.int64()))], ["bag", "items", "bits"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(in_slices(step, 0), "bag binary, items array<long>, bits array<long>")


def _only(rows: DataFrame, ids: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Semi or anti join with a set of ids, which is broadcast only if it is small."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def _verify(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """pairs(a, b), each once -> those whose weighted Jaccard similarity is at least ``least``. An a of more than SPLIT pairs is dealt
    out over several tasks."""
    hot = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / SPLIT).alias("parts")).filter("parts > 1"), "near-hot")
    parts = F.coalesce("parts", F.lit(1))
    left = sets.select(F.col("bag").alias("a"), F.col("items").alias("x")).join(hot, "a", "left").select("a", "x", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    right = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("part")).join(sets.select(F.col("bag").alias("b"), F.col("items").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    found = right.join(left, ["a", "part"]).select("a", "b", (shared / (F.size("x") + F.size("y") - shared)).alias("similarity"))
    return materialize(found.filter(F.col("similarity") >= least), "near-links")


def _can_reach(x: str, y: str, least: float) -> Column:
    """Whether the bags of rows x and y can be that similar: neither holds what the other's sketch lacks."""
    lacks = lambda a, b: " + ".join(f"bit_count({a}.bits[{i}] & ~{b}.bits[{i}])" for i in range(SKETCH // 64))
    enough = lambda a, b: f"({a}.size - ({lacks(a, b)})) * {1 + least}D >= ({a}.size + {b}.size) * {least}D - 1e-9D"
    return F.expr(f"least({x}.size, {y}.size) >= greatest({x}.size, {y}.size) * {least}D - 1e-9D AND {enough(x, y)} AND {enough(y, x)}")


def _pairs(met: DataFrame) -> DataFrame:
    """Each pair of rows x and y once, the one that meets more others as a."""
    first = "struct(x.weight, x.vertex) > struct(y.weight, y.vertex)"
    return met.select(F.expr(f"if({first}, x.vertex, y.vertex)").alias("a"), F.expr(f"if({first}, y.vertex, x.vertex)").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> vertex, root: the smallest vertex of its component. Labels fall to the least neighbour's and
    then to their own label's label until nothing changes; one written table a round."""
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    state = materialize(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "near-roots")
    while True:
        near = both.join(state.select(F.col("vertex").alias("b"), "root"), "b").groupBy(F.col("a").alias("vertex")).agg(F.min("root").alias("near"))
        lower = state.join(near, "vertex").select("vertex", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        jump = state.select(F.col("vertex").alias("root"), F.col("root").alias("up"))
        new = materialize(lower.join(jump, "root", "left").select("vertex", F.least("root", "up").alias("root"), "old"), "near-roots")
        discard(state)
        if new.filter("root != old").isEmpty():
            discard(both)
            return new.select("vertex", "root")
        state = new.select("vertex", "root")


def _classes(docs: DataFrame, least: float, bands: int = BANDS, rows: int = ROWS, shingle: int = 5) -> DataFrame:
    """docs(doc_id, text, ...) -> doc (LAST for null), copy (hash of the text), root (one for each class), one row for each row."""
    made = materialize(signatures(docs, bands, rows, shingle), "near-signatures")
    vertices = materialize(made.groupBy("bag").agg(F.min(F.struct("doc", "copy")).alias("at"), F.first("size").alias("size"), F.first("bands").alias("bands")), "near-vertices")
    placed = vertices.select(F.col("bag").alias("vertex"), F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = materialize(placed.join(shared, "bucket"), "near-buckets")
    # what a vertex meets in all its buckets: largest near the middle of a group
    weights = materialize(buckets.groupBy("vertex").agg(F.sum("n").alias("weight")).join(vertices.select(F.col("bag").alias("vertex"), "at", "size"), "vertex"), "near-weights")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_or_empty()).alias("copy"), "text")
    sets = materialize(_item_sets(_only(texts, weights.select("at.doc", "at.copy"), ["doc", "copy"], "left_semi"), shingle).dropDuplicates(["bag"]), "near-sets")
    discard(vertices)
    known = weights.select("vertex", "weight", "size").join(sets.select(F.col("bag").alias("vertex"), "bits"), "vertex")
    members = materialize(buckets.select("bucket", "vertex").join(known, "vertex"), "near-members")
    discard(buckets, weights)
    leaders = members.groupBy("bucket").agg(F.max(F.struct("weight", "vertex", "size", "bits")).alias("l")).select("bucket", "l.*")
    met = members.alias("x").join(leaders.alias("y"), F.expr("x.bucket = y.bucket AND x.vertex != y.vertex") & _can_reach("x", "y", least))
    pairs = materialize(_pairs(met), "near-pairs")
    links = _verify(pairs, sets, least)
    roots = components(links)
    own = members.join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    mixed = own.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.sum("n").alias("n"), F.count("*").alias("roots")).filter("roots > 1")
    own = materialize(own.join(mixed.select("bucket", "largest", F.ceil(F.col("n") / SPLIT).alias("parts")), "bucket"), "near-mixed")
    discard(members)
    minor = own.filter("root != largest").withColumn("part", F.pmod(F.xxhash64("vertex"), "parts"))
    others = own.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = minor.alias("x").join(others.alias("y"), F.expr("x.bucket = y.bucket AND x.part = y.part AND x.root != y.root") & _can_reach("x", "y", least))
    rest = materialize(_pairs(met).join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    if not rest.isEmpty():
        more = _verify(rest, sets, least)
        roots = roots if more.isEmpty() else components(links.union(more))
    whole = materialize(made.select("doc", "copy", "bag").join(roots.withColumnRenamed("vertex", "bag"), "bag", "left").select("doc", "copy", F.coalesce("root", "bag").alias("root")), "near-classes")
    discard(made, sets, own, pairs, rest)
    return whole


def near_duplicates(docs: DataFrame, least: float = 0.8, bands: int = BANDS, rows: int = ROWS, shingle: int = 5) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, class_id: the smallest doc_id of the row's class, one row for each row.

    Classes are the connected components of weighted Jaccard >= ``least`` over multisets of five-word shingles (words
    between blanks, A-Z lower-cased; a text of fewer words is one shingle). Null and blank texts are one class. Repeated rows
    are of one class. Rows of one id and different texts count as different texts. A null id counts as larger than any other and is
    the class_id only of a class of null ids. An empty table gives no rows; other columns are ignored.
    """
    whole = _classes(docs, least, bands, rows, shingle)
    least_doc = whole.groupBy("root").agg(F.min("doc").alias("class"))
    shown = lambda c: F.when(F.col(c) < LAST, F.col(c))
    return whole.join(least_doc, "root").select(shown("doc").alias("doc_id"), shown("class").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """docs with one row of each class of near_duplicates(): one that has the class's smallest doc_id. Rows of one id, or of
    none, and different texts are judged each by itself. All columns pass."""
    each = _classes(docs, least).groupBy("doc", "copy").agg(F.first("root").alias("root"), F.count("*").alias("rows"))
    first = each.groupBy("root").agg(F.min(F.struct("doc", "copy")).alias("first"))
    stays = F.struct("doc", "copy") == F.col("first")
    gone = materialize(each.join(first, "root").select("doc", "copy", stays.alias("stays"), "rows").filter("not stays or rows > 1"), "near-gone")
    names, key = docs.columns, ["doc", "copy"]
    packed = docs.select(F.struct(*names).alias("row"))
    packed = packed.select("row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_or_empty("row.text")).alias("copy"))
    kept = _only(packed, gone.select(*key), key, "left_anti").select("row.*")
    repeated = gone.filter("stays").select(*key)  # several rows of one id and text: one of them
    if repeated.isEmpty():
        return kept
    some = _only(packed, repeated, key, "left_semi").dropDuplicates(key).select("row.*")
    return kept.unionByName(some)


def op6_near_duplicates(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
