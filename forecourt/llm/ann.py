"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals.

Centroids (two levels: cells within districts) and codebooks are fitted on a bounded sample; every vector is indexed. A query
probes its best cells, as many as held nearly all true neighbours when vectors of the sample were searched by brute force
in it, and more where those hold too few rows; within a cell, asymmetric tables (query against codewords) give approximate
inner products. A row's quantisation error is kept with its codes; with it every approximate product has a lower and an upper
bound, and all rows whose upper bound reaches the k-th best lower bound are ranked again by the exact inner product
of the original vectors, however many they are. Queries go to their cells only; a cell that is too large for one task (it may
hold a third of all rows) is dealt out, and so are its queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Rows the centroids are fitted on, about (drawn by a hash of the id), rows for each codebook at most, and rows in a cell, about,
#: as long as CELLS are enough.
SAMPLE, BOOK_ROWS, CELL_ROWS = 65_536, 16_384, 1_024
CELLS = SAMPLE // 8
#: Index rows and queries of a cell that meet in one task, about.
SHARD, BLOCK = 8_192, 2_048
#: Share of the true neighbours within the sample that the probed cells must hold, and queries that measure it.
COVER, TRIALS = 0.985, 256


@dataclass
class Model:
    centroids: np.ndarray  # cells x dim, those of one district together
    codebooks: np.ndarray  # parts x codes x (dim / parts)
    districts: np.ndarray  # centres of the districts
    first: np.ndarray  # of each district its first cell, and the number of cells
    probes: int = 0
    reach: float = 1.0  # largest error of a product that was measured, as a part of the norms of query and row error
    sample: np.ndarray | None = None  # distinct vectors; their k-th best product is a lower bound of a query's k-th best
    sample_cells: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def parts(self) -> int:
        return len(self.codebooks)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The nearest cell of the nearest district."""
        own, out = nearest(x, self.districts), np.zeros(len(x), np.int64)
        for d in np.unique(own):
            mine = own == d
            out[mine] = self.first[d] + nearest(x[mine], self.centroids[self.first[d] : self.first[d + 1]])
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = self.cells(x)
        rest = (x - self.centroids[cells]).reshape(len(x), self.parts, -1)
        return cells, np.stack([nearest(rest[:, p], self.codebooks[p]) for p in range(self.parts)], 1).astype(np.uint8)

    def errors(self, x: np.ndarray, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes leave out of each vector."""
        return x - self.centroids[cells] - np.concatenate([book[codes[:, p]] for p, book in enumerate(self.codebooks)], 1)

    def probed(self, q: np.ndarray, rows: np.ndarray, k: int) -> list[np.ndarray]:
        """The cells that each query probes, best first: ``probes`` of those that hold rows, and more until they hold k + 1 rows."""
        out = []
        for order in np.argsort(-(q @ self.centroids.T), 1, kind="stable"):
            held = order[rows[order] > 0]
            enough = np.searchsorted(np.cumsum(rows[held]), k + 1) + 1
            out.append(held[: max(self.probes, enough)])
        return out

    def least(self, q: np.ndarray, cells: list[np.ndarray], k: int) -> np.ndarray:
        """Of each query a product that k other vectors of its cells reach at least; -inf if the sample has too few of them."""
        out = np.full(len(q), -np.inf)
        for i in range(0, len(q), 64):
            products = q[i : i + 64] @ self.sample.T
            for j, own in enumerate(cells[i : i + 64]):
                wanted = np.zeros(len(self.centroids), bool)
                wanted[own] = True
                mine = products[j, wanted[self.sample_cells]]
                if len(mine) > k:
                    out[i + j] = np.partition(mine, -k - 1)[-k - 1]
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of each row of x the nearest centre by Euclidean distance, the first of equals."""
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64), *(np.argmax(x[i : i + 4096] @ centres.T - half, 1) for i in range(0, len(x), 4096))])


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=k)
        sums = np.stack([np.bincount(own, x[:, d], minlength=k) for d in range(x.shape[1])], 1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.choice(len(x), k)])
    return centres


def probes_needed(model: Model, k: int, seed: int) -> int:
    """How many best cells a query must probe to meet COVER of its k nearest."""
    trial = model.sample[np.random.default_rng(seed).choice(len(model.sample), min(TRIALS, len(model.sample)), replace=False)]
    few = min(k + 1, len(model.sample))
    top = np.concatenate([np.argpartition(-(trial[i : i + 32] @ model.sample.T), few - 1, 1)[:, :few] for i in range(0, len(trial), 32)])
    own = model.sample_cells[top]
    order = np.argsort(np.argsort(-(trial @ model.centroids.T), 1, kind="stable"), 1)
    place = np.sort(np.take_along_axis(order, own, 1).ravel())
    return int(place[min(len(place) - 1, int(COVER * len(place)))]) + 1


def fit(sample: np.ndarray, cells: int, parts: int, codes: int, k: int, seed: int = 7) -> Model:
    distinct = np.unique(sample, axis=0)
    districts = kmeans(distinct, max(1, round(cells**0.5)), 8, seed)
    own = nearest(distinct, districts)
    shares = np.bincount(own, minlength=len(districts)) * cells / len(distinct)
    within = [kmeans(distinct[own == d], max(1, round(shares[d])), 8, seed + d) if (own == d).any() else districts[d : d + 1] for d in range(len(districts))]
    first = np.concatenate([[0], np.cumsum([len(w) for w in within])])
    model = Model(np.concatenate(within), np.zeros((parts, 0, 0)), districts, first, sample=distinct)
    model.sample_cells = model.cells(distinct)
    few = np.random.default_rng(seed).permutation(len(distinct))[:BOOK_ROWS]
    rest = (distinct[few] - model.centroids[model.sample_cells[few]]).reshape(len(few), parts, -1)
    model.codebooks = np.stack([kmeans(rest[:, p], codes, 6, seed + 1 + p) for p in range(parts)])
    model.probes = probes_needed(model, k, seed)
    model.reach = error_reach(model, distinct[few], seed)
    return model


def error_reach(model: Model, sample: np.ndarray, seed: int) -> float:
    """The largest |query x error| / (|query| |error|) of TRIALS queries and all rows of the sample; 1 can't be exceeded."""
    trial = sample[np.random.default_rng(seed).choice(len(sample), min(TRIALS, len(sample)), replace=False)]
    trial = trial / np.linalg.norm(trial, axis=1, keepdims=True)
    left = model.errors(sample, *model.encode(sample))
    norms = np.linalg.norm(left, axis=1)
    left = left[norms > 1e-9] / norms[norms > 1e-9, None]
    return min(1.0, max((float(np.abs(left[i : i + 4096] @ trial.T).max()) for i in range(0, len(left), 4096)), default=1.0))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part: not null, not empty, no null or non-finite component, not
    all zero, and of the dimension that most rows have (the larger of equals)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine & F.exists("embedding", lambda c: c != 0.0))
    top = v.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).agg(F.max_by("dim", F.struct("n", "dim"))).first()[0]
    return v.filter(F.size("embedding") == (top or 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, probes: int | None = None, parts: int = 32) -> DataFrame:
    """vectors(vec_id, embedding, ...), queries (ids in a column query_id, a subset of vec_id) -> query_id, rank, vec_id,
    score: of each query that takes part its k nearest found, by largest inner product, the query's own id left out.

    score is the inner product of the original vectors in double precision; ties go to the smaller vec_id. Rows of one
    vec_id are one vector (its least row by value). Vectors null, zero, with null or non-finite components or of
    an odd dimension take no part. Fewer candidates than k: all of them. Empty tables give no rows.
    Every row of the probed cells that can be among the k nearest by the measured error of its approximate product is
    ranked by its exact one; of equal vectors only the first k + 1 by vec_id can be, the others are not indexed.
    There is a cell for every CELL_ROWS rows, CELLS at most (beyond, cells grow and are dealt out over tasks). probes: cells
    probed, measured on the sample if None. parts: codebooks at most, so that they divide the dimension.
    """
    spark = vectors.sparkSession
    base = materialize(valid_vectors(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "ann-vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    n = base.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    drawn = base if n <= SAMPLE else base.filter(F.pmod(F.xxhash64("vec_id"), F.lit(2**31)) < int(SAMPLE / n * 2**31))
    sample = drawn.toArrow()  # SAMPLE rows, about
    sample = _matrix(sample.sort_by("vec_id").column("embedding").combine_chunks())
    parts = max(p for p in range(1, min(parts, sample.shape[1]) + 1) if sample.shape[1] % p == 0)
    model = fit(sample, min(CELLS, max(1, n // CELL_ROWS)), parts, 256, k)
    model.probes = probes or model.probes
    shared = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            cells, codes = shared.value.encode(x)
            off = np.linalg.norm(shared.value.errors(x, cells, codes), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(off)], ["vec_id", "cell", "codes", "off"])

    alike = Window.partitionBy("embedding").orderBy("vec_id")
    needed = base.withColumn("copy", F.row_number().over(alike)).filter(F.col("copy") <= k + 1).select("vec_id", "embedding")
    index = materialize(needed.mapInArrow(encode, "vec_id long, cell int, codes binary, off double"), "ann-index")
    sizes = index.groupBy("cell").agg(F.count("*").alias("n"))
    rows = np.zeros(len(model.centroids), np.int64)
    for r in sizes.collect():  # one row a cell
        rows[r["cell"]] = r["n"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                q = _matrix(part.column(1))
                cells = shared.value.probed(q, rows, k)
                many = np.array([len(c) for c in cells])
                again = pa.array(np.repeat(np.arange(len(q)), many))
                least = np.repeat(shared.value.least(q, cells, k), many)
                best = np.concatenate([np.arange(m) == 0 for m in many])
                yield pa.RecordBatch.from_arrays([part.column(0).take(again), pa.array(np.concatenate(cells), pa.int32()), part.column(1).take(again), pa.array(least), pa.array(best)], ["query_id", "cell", "vector", "least", "best"])

    asked = base.join(queries.select(F.col("query_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "embedding")
    asked = materialize(asked.mapInArrow(probe, "query_id long, cell int, vector array<double>, least double, best boolean"), "ann-asked")
    asking = asked.groupBy("cell").agg(F.count("*").alias("asking"))
    # CELLS rows at most
    layout = F.broadcast(sizes.join(asking, "cell").select("cell", F.ceil(F.col("n") / SHARD).cast("int").alias("parts"), F.ceil(F.col("asking") / BLOCK).cast("int").alias("blocks")))
    spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c, by: F.pmod(F.xxhash64(c), F.col(by)).cast("int")
    left = asked.join(layout, "cell").withColumns({"block": own("query_id", "blocks"), "part": spread("parts")}).drop("parts", "blocks")
    right = index.join(layout, "cell").withColumns({"part": own("vec_id", "parts"), "block": spread("blocks")}).drop("parts", "blocks")

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "low": np.zeros(0), "high": np.zeros(0)})]
        if len(left) and len(right):
            m, cell = shared.value, int(right["cell"].iloc[0])
            right = right.sort_values("vec_id")
            ids, off = right["vec_id"].to_numpy(), right["off"].to_numpy()
            codes = np.frombuffer(b"".join(right["codes"]), np.uint8).reshape(len(right), m.parts)
        for a in range(0, len(left) if len(right) else 0, 128):
            part = left.iloc[a : a + 128]
            q, asks = np.stack(part["vector"].to_numpy()).astype(np.float64), part["query_id"].to_numpy()
            tables = np.einsum("qpd,pcd->pcq", q.reshape(len(q), m.parts, -1), m.codebooks)
            near = np.repeat((q @ m.centroids[cell])[None, :], len(ids), 0)
            for p in range(m.parts):
                near += tables[p][codes[:, p]]
            near = np.ascontiguousarray(near.T)
            near[asks[:, None] == ids[None, :]] = -np.inf
            slack = m.reach * np.linalg.norm(q, axis=1)[:, None] * off[None, :] + 1e-9 * np.abs(np.where(np.isfinite(near), near, 0))
            low, high = near - slack, near + slack
            few = min(k, low.shape[1])
            kth = -np.partition(-low, few - 1, 1)[:, few - 1]
            row, at = np.nonzero(np.isfinite(near) & ((high >= np.maximum(kth, part["least"].to_numpy())[:, None]) | (part["best"].to_numpy()[:, None] & (low >= kth[:, None]))))
            found.append(pd.DataFrame({"query_id": asks[row], "vec_id": ids[at], "low": low[row, at], "high": high[row, at]}))
        return pd.concat(found)

    keys = ["cell", "part", "block"]
    met = materialize(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(scan, "query_id long, vec_id long, low double, high double"), "ann-met")
    by_query = Window.partitionBy("query_id")
    lows = met.withColumn("place", F.row_number().over(by_query.orderBy(F.desc("low"), "vec_id"))).filter(F.col("place") <= k).groupBy("query_id").agg(F.min("low").alias("least"))
    first = met.join(lows, "query_id").filter("high >= least").select("query_id", "vec_id")
    q, c = base.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), base.select("vec_id", F.col("embedding").alias("c"))
    exact = F.aggregate(F.zip_with("q", "c", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = first.join(c, "vec_id").join(q, "query_id").select("query_id", "vec_id", exact.alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id")))
    out = materialize(ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ann-found")
    discard(base, index, asked, met)
    shared.destroy()
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def op8_nearest_vectors(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id")))
