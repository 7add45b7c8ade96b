"""Benchmark decontamination by greedy string tiling.

The benchmark's word runs (seeds of ``least_tile`` words) are the build side of a hash join with the seeds of each document, which is
probed where the document is read; Karp-Rabin hashes roll over word numbers. Equal seeds on one diagonal join to maximal matches; the longest is
marked, overlaps are cut back, and so on until no match of ``least_tile`` words is left. The share of an item's words that tiles
cover is tested, so passages count in any order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty
from .license_scan import _WORD

#: Words of benchmark text that one pass carries to the tasks (some 50 MB). A larger benchmark is met in several passes, over those
#: documents only that hold a seed by a filter of FILTER_BITS bits (64 MB) at most, 16 for each word of the benchmark otherwise.
PASS_WORDS, FILTER_BITS = 1_000_000, 2**29
#: So many words of an item in tiles are a leak, whatever part of a long item they are.
LEAK_WORDS = 50
#: Pairs of equal seeds that are listed at once; where a text and an item have more, their diagonals are compared one by one.
PAIRS = 1_000_000
_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters of a UTF-8 text."""
    return _WORD.findall(text.lower())


def rolling(numbers: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash of every run of k numbers."""
    n = max(0, len(numbers) - k + 1)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            total = total * _MULTIPLIER + numbers[i : i + n].astype(np.uint64)
    return total


def diagonal_matches(item: np.ndarray, text: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(-words, start in item, start in text) of all maximal matches of at least ``least`` known words, a diagonal at a time:
    memory for one diagonal, however often words repeat."""
    for d in range(least - len(item), len(text) - least + 1):
        a, b = max(0, -d), max(0, d)
        n = min(len(item) - a, len(text) - b)
        same = np.zeros(n + 2, bool)
        same[1:-1] = item[a : a + n] == text[b : b + n]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start >= least:
                yield int(start - end), int(a + start), int(b + start)


def greedy_tiles(item: np.ndarray, text: np.ndarray, seeds: tuple[np.ndarray, np.ndarray] | None, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, words), longest first, ties by start in item, then in text. seeds: starts
    in item and text of all equal runs of ``least`` words; None: they are too many to list."""
    if seeds is None:
        heap = list(diagonal_matches(item, text, least))
    else:
        p, j = seeds
        order = np.lexsort((p, j - p))
        p, j = p[order], j[order]
        new = np.ones(len(p), bool)
        new[1:] = (np.diff(j - p) != 0) | (np.diff(p) != 1)
        at = np.flatnonzero(new)
        lengths = np.diff(np.append(at, len(p))) + least - 1
        heap = [(-int(n), int(a), int(b)) for n, a, b in zip(lengths, p[at], j[at]) if np.array_equal(item[a : a + n], text[b : b + n])]
    heapq.heapify(heap)
    taken_item, taken_text, tiles = np.zeros(len(item), bool), {}, []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [not taken_item[a + i] and (b + i) not in taken_text for i in range(n)]
        if all(free):
            taken_item[a : a + n] = True
            taken_text.update(dict.fromkeys(range(b, b + n)))
            tiles.append((a, b, n))
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= least:
                    heapq.heappush(heap, (start - i, a + start, b + start))
                start = None
    return tiles


class SeedIndex:
    """Seeds of some benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], least_tile: int, coverage: float):
        self.least, self.coverage = least_tile, coverage
        self.number: dict[bytes, int] = {}
        self.ids, self.items = [], []
        hashes, owners, starts = [], [], []
        for item_id, text in items:
            numbers = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)], np.int64)
            if len(numbers) < least_tile:
                continue
            h = rolling(numbers, least_tile)
            hashes.append(h)
            owners.append(np.full(len(h), len(self.ids)))
            starts.append(np.arange(len(h)))
            self.ids.append(item_id)
            self.items.append(numbers)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owners = np.concatenate([np.zeros(0, np.int64), *owners])[order]
        self.starts = np.concatenate([np.zeros(0, np.int64), *starts])[order]

    def matches(self, text: bytes) -> list[tuple[int, int, int, float, list]]:
        """(item_id, covered words, item words, coverage, tiles) of the items that reach the coverage."""
        numbers = np.fromiter(map(lambda w, get=self.number.get: get(w, 0), words_of(text)), np.int64)
        if len(numbers) < self.least or not len(self.hashes):
            return []
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        at = np.flatnonzero(known[self.least :] - known[: -self.least] == self.least)
        if not len(at):
            return []
        h = rolling(numbers, self.least)[at]
        low, high = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, "right")
        some = high > low
        at, low, high = at[some], low[some], high[some]
        if not len(at):
            return []
        found, each = [], high - low
        if each.sum() <= PAIRS:
            row = np.repeat(low - np.cumsum(each) + each, each) + np.arange(each.sum())
            owner, start, place = self.owners[row], self.starts[row], np.repeat(at, each)
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
            met = [(int(owner[mine[0]]), (start[mine], place[mine])) for mine in np.split(order, cuts[1:])]
        else:
            met = [(k, None) for k in sorted({int(k) for a, b in {*zip(low.tolist(), high.tolist())} for k in self.owners[a:b]})]
        for k, seeds in met:
            tiles = greedy_tiles(self.items[k], numbers, seeds, self.least)
            covered, whole = sum(t[2] for t in tiles), len(self.items[k])
            if covered >= min(self.coverage * whole, LEAK_WORDS):
                found.append((self.ids[k], covered, whole, covered / whole, tiles))
        return found


class SeedFilter:
    """A Bloom filter of the seeds of a whole benchmark: tells the documents that hold none of them, which are nearly all."""

    def __init__(self, words: int, least_tile: int):
        self.least, self.size = least_tile, 1 << max(10, min(FILTER_BITS, 16 * words).bit_length() - 1)
        self.bits = np.zeros(self.size // 8, np.uint8)

    def _seeds(self, text: bytes) -> np.ndarray:
        h = rolling(np.fromiter(map(xxhash.xxh3_64_intdigest, words_of(text)), np.uint64), self.least)
        with np.errstate(over="ignore"):
            return np.stack([h * _MULTIPLIER >> _U(20), (h ^ (h >> _U(31))) * _U(0xD1342543DE82EF95) >> _U(20)]) % _U(self.size)

    def add(self, text: bytes) -> None:
        at = self._seeds(text).ravel()
        np.bitwise_or.at(self.bits, (at >> _U(3)).astype(np.int64), np.left_shift(1, (at & _U(7)).astype(np.int64)).astype(np.uint8))

    def holds(self, text: bytes) -> bool:
        at = self._seeds(text)
        return bool((self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).all(0).any())


def _parts(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in parts of PASS_WORDS words, about."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    chars = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-chars // (5 * PASS_WORDS)))
    return [items] if parts == 1 else [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) for part in range(parts)]


def _passes(parts: list[DataFrame], least_tile: int, coverage: float) -> Iterator[SeedIndex]:
    """An index of each part; only one is on the driver at a time."""
    for rows in parts:
        yield SeedIndex(sorted(((r["item_id"], r["text"].encode()) for r in rows.collect()), key=lambda r: (r[0] is None, r)), least_tile, coverage)


def _with_seeds(docs: DataFrame, parts: list[DataFrame], least_tile: int) -> DataFrame:
    """The rows of docs whose text may hold a seed of the benchmark, written."""
    seeds = SeedFilter(len(parts) * PASS_WORDS, least_tile)
    for rows in parts:
        for r in rows.toLocalIterator():
            seeds.add(r["text"].encode())
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([t.is_valid and shared.value.holds(t.as_buffer().to_pybytes()) for t in batch.column(at)], pa.bool_()))

    found = materialize(docs.mapInArrow(run, docs.schema), "tiles-candidates")
    shared.destroy()
    return found


TILES = "array<struct<item_start:int,text_start:int,words:int>>"


def contaminated(docs: DataFrame, benchmark: DataFrame, least_tile: int = 5, coverage: float = 0.5) -> DataFrame:
    """docs(doc_id, text, ...), benchmark(item_id, text, ...) -> doc_id, item_id, covered, item_words, coverage, tiles: one
    row for each document and item of which tiles of at least ``least_tile`` words cover at least ``coverage`` or LEAK_WORDS words.

    Null text counts as empty and holds nothing; items of fewer than ``least_tile`` words can hold no tile and match
    nothing. Repeated rows (of either table) each give their rows; null ids pass; other columns are ignored. Empty tables give no
    rows. No shuffle: one scan of the documents; if the benchmark is of several parts, one scan of those that hold a seed for each part
    more. A text is held whole, with some 50 bytes a word; matches take memory for PAIRS pairs of equal seeds at most.
    """
    kind = pa.list_(pa.struct([("item_start", pa.int32()), ("text_start", pa.int32()), ("words", pa.int32())]))
    texts, parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), _parts(benchmark)
    if len(parts) > 1:
        texts = _with_seeds(texts, parts, least_tile)
    schema = f"doc_id long, item_id long, covered long, item_words long, coverage double, tiles {TILES}"
    whole = None
    for index in _passes(parts, least_tile, coverage):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d.as_py(), *m) for d, t in zip(batch.column(0), batch.column(1)) for m in shared.value.matches(t.as_buffer().to_pybytes())]
                columns = list(zip(*rows)) if rows else [[]] * 6
                tiles = [[dict(zip(("item_start", "text_start", "words"), t)) for t in x] for x in columns[5]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.float64()), pa.array(tiles, kind)], ["doc_id", "item_id", "covered", "item_words", "coverage", "tiles"])

        found = texts.mapInArrow(run, schema)
        whole = found if whole is None else whole.unionByName(found)
    return whole


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, least_tile: int = 5, coverage: float = 0.5) -> DataFrame:
    """docs without the documents that contaminated() finds; all columns pass as they are, whatever their names."""
    at, parts = docs.columns.index("text"), _parts(benchmark)
    if len(parts) > 1:
        # documents without a seed stay; those found among the others go, by id and text
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        seen = contaminated(_with_seeds(ids, parts, least_tile).select(F.xxhash64("doc_id", "text").alias("doc_id"), "text"), benchmark, least_tile, coverage)
        gone = materialize(seen.select("doc_id").distinct(), "tiles-found")
        names = docs.columns
        packed = docs.select(F.struct(*names).alias("row")).withColumn("doc_id", F.xxhash64(F.col("row.doc_id").cast("long"), "row.text"))
        return packed.join(gone, "doc_id", "left_anti").select("row.*")
    for index in _passes(parts, least_tile, coverage):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not t.is_valid or not shared.value.matches(t.as_buffer().to_pybytes()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontaminate(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
