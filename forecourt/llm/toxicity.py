"""Toxicity by nearest labelled examples under exact TF-IDF cosine of whole texts.

Examples lie in a block-max inverted index: blocks of similar examples, and for every term its postings cut by block, each cut with its
largest weight. The sum of weight times block maximum over a text's terms bounds its similarity to any example of a block.
Blocks with the best bounds are scored first, and then only those whose bound reaches the k-th best similarity found; the postings
of all others are never read. Every similarity that decides is exact. Lengths are those of the whole text: terms that no
example has count in them, too.
The k nearest vote, classes weighed as they stand among all labels. A neighbour's vote is the square of what its similarity
owes to terms that tell the classes apart: each term's share of the cosine times its relevance. Relevance has no part in
who is near. Isotonic regression on leave-one-out votes of the examples calibrates the votes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_rest, labelled_sample, materialize, text_or_empty, text_slices

#: Labelled documents of each class among the examples at most, the bytes of their texts together, and those of one text.
PER_CLASS, BYTES, LONGEST = 3_000, 64_000_000, 1_000_000
#: Terms kept as dense rows at most, the most frequent ones, and the share of examples that such a term has at least (layout only: a
#: dense row costs every text, postings only those with the term); texts that are compared at once.
DENSE, OFTEN, TEXTS = 512, 1 / 20, 128
#: Cells in which the documents of terms that no example has are counted: 2 ** 18.
CELLS = 1 << 18
#: Examples in a block, about, and blocks that are scored before bounds are compared.
BLOCK, FIRST = 512, 2
NEIGHBOURS, EVIDENCE = 25, 5
#: What is added to the neighbours' votes and falls as all labels stand, of the median of examples' votes.
PRIOR = 0.1


#: ASCII letters in lower case, digits and all bytes from 0x80 on as they are, blanks for the rest.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def vocabulary(sample: DataFrame) -> dict[bytes, float]:
    """All terms of the examples, each with its relevance: the squared correlation (0 to 1) of its presence with the label. The most
    frequent come first, so that what most lookups meet lies together in memory."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen.update((t, label) for t in set(terms_of(text.as_buffer().to_pybytes())))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in seen], pa.binary()), pa.array([label for _, label in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "label", "n"])

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    bad, fine = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    # one row for each term of the examples
    found = sample.select("label", "text").mapInArrow(count, "term binary, label int, n long").groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b")).orderBy((F.col("a") + F.col("b")).desc(), "term").toArrow()
    a, b = found["a"].to_numpy().astype(float), found["b"].to_numpy().astype(float)
    phi = np.abs(a * fine - b * bad) / np.sqrt(np.maximum(bad * fine * (a + b) * (bad + fine - a - b), 1.0))
    return dict(zip(found["term"].to_pylist(), (np.minimum(phi, 1.0) ** 2).tolist()))


def document_counts(docs: DataFrame, terms: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """In how many of all documents each term stands; for all other terms, counts by cell of their hash; the number of documents."""
    number = {t: i for i, t in enumerate(terms)}
    known, wanted = len(number), docs.sparkSession.sparkContext.broadcast(number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the terms by number, then the cells, then the documents
        seen = np.zeros(known + CELLS + 1, np.int64)
        for batch in batches:
            seen[-1] += len(batch)
            for text in batch.column(0):
                at = _numbered(wanted.value, list(set(terms_of(text.as_buffer().to_pybytes()))))
                np.add.at(seen, np.where(at < 0, known - 1 - at, at), 1)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(seen[held])], ["at", "n"])

    # one row for each term of the examples, and CELLS at most
    rows = docs.select(text_or_empty().alias("text")).mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(known + CELLS + 1, np.int64)
    counts[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return counts[:known], counts[known:-1], int(counts[-1])


def _cells(terms: Iterable[bytes]) -> np.ndarray:
    return np.array([crc32(t) & (CELLS - 1) for t in terms], np.int64)


def _numbered(number: dict[bytes, int], terms: list[bytes]) -> np.ndarray:
    """The number of each term, or -1 - cell of those without."""
    at = np.fromiter(map(number.get, terms, repeat(-1)), np.int64, len(terms))
    other = np.flatnonzero(at < 0)
    at[other] = -1 - _cells(map(terms.__getitem__, other.tolist()))
    return at


def rarity(counts: np.ndarray, n: int) -> np.ndarray:
    """Smoothed inverse document frequency."""
    return np.log((1 + n) / (1 + counts)) + 1


@dataclass
class Model:
    weights: dict[bytes, float]  # of every term of the examples: its idf
    unknown: np.ndarray = field(default_factory=lambda: np.ones(CELLS, np.float32))  # idf of all other terms, by cell
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of examples, in index order
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    class_weight: tuple[float, float] = (1.0, 1.0)
    # posting blocks: where a term's begin; of each one its block, largest weight and first posting; of postings example and weight
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    examples: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # the same of frequent terms, as matrices
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # of each term: its row in dense, or -1
    dense: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # frequent terms x examples
    dense_most: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # frequent terms x blocks
    # terms of each example, in index order, and their weights times relevance
    own: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    own_terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    own_values: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    prior: float = 1e-12  # vote that is added to the neighbours' and falls as all labels stand
    base: float = 0.0  # share of toxic ones among the examples without a term
    steps: tuple[np.ndarray, np.ndarray] | None = None  # calibration

    def __post_init__(self):
        self.number = {t: i for i, t in enumerate(self.weights)}
        self.weight = np.array(list(self.weights.values()), float)
        self.weights = {}  # held once

    def vectors(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, value) of TF-IDF, (1 + log tf) * idf, over the length of the whole text's vector; rows of the terms that
        examples have. Nothing where a text has none."""
        owner, term, count, texts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], list(texts)
        for i, text in enumerate(texts):
            seen = Counter(terms_of(text))
            owner.append(np.full(len(seen), i))
            term.append(_numbered(self.number, list(seen)))
            count.append(np.fromiter(seen.values(), np.int64, len(seen)))
        owner, term, count = np.concatenate(owner), np.concatenate(term), np.concatenate(count)
        known = term >= 0
        idf = np.empty(len(term))
        idf[known], idf[~known] = self.weight[term[known]], self.unknown[-1 - term[~known]]
        value = (1 + np.log(np.maximum(count, 1))) * idf
        norm = np.sqrt(np.bincount(owner, value**2, minlength=len(texts)))
        return owner[known], term[known], (value / np.maximum(norm[owner], 1e-12))[known]

    def index(self, ids: np.ndarray, x: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, relevance: np.ndarray | None = None) -> None:
        owner, term, value = x
        some = np.bincount(owner, minlength=len(ids)) > 0
        ratio = np.where(labels == 1, self.class_weight[1], self.class_weight[0])
        self.base = float((ratio * labels)[~some].sum() + self.share()) / float(ratio[~some].sum() + 1)
        order = np.flatnonzero(some)
        if len(order):
            order = order[np.lexsort((ids[order], _alike(x, len(ids))[order]))]  # similar ones together: layout only
        place = np.full(len(ids), -1)
        place[order] = np.arange(len(order))
        self.ids, self.labels, owner = ids[order], labels[order], place[owner]
        by = np.argsort(owner, kind="stable")
        self.own, self.own_terms = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(order)))]), term[by].astype(np.int32)
        self.own_values = (value if relevance is None else value * relevance[term])[by].astype(np.float32)
        blocks = -(-len(order) // BLOCK)
        held = np.bincount(term, minlength=len(self.weight))
        often = np.argsort(-held, kind="stable")[:DENSE]
        often = often[held[often] > len(order) * OFTEN]
        self.row = np.full(len(held), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.dense, full = np.zeros((len(often), len(order))), self.row[term] >= 0
        self.dense[self.row[term[full]], owner[full]] = value[full]
        self.dense_most = np.zeros((len(often), blocks))
        np.maximum.at(self.dense_most, (self.row[term[full]], owner[full] // BLOCK), value[full])
        owner, term, value = owner[~full], term[~full], value[~full]
        by = np.lexsort((owner, term))
        owner, term, self.values = owner[by], term[by], value[by]
        self.examples = owner.astype(np.int32)
        key = term.astype(np.int64) * max(blocks, 1) + owner // BLOCK
        at = np.flatnonzero(np.diff(key, prepend=-1))
        self.first, self.block = np.append(at, len(key)), (owner[at] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(self.values, at) if len(at) else np.zeros(0)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term[at], minlength=len(held)))])

    def share(self) -> float:
        return self.class_weight[1] / (self.class_weight[0] + self.class_weight[1]) if sum(self.class_weight) else 0.0

    def nearest(self, texts: int, x: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, place in the index) of the k nearest of each text, best first, ties by id; -1 where there are fewer
        with a similarity over 0. skip: an id that each text must not meet."""
        best, place, n = np.full((texts, k), -1.0), np.full((texts, k), -1), len(self.ids)
        if not n:
            return best, place
        owner, term, value = x
        frequent = self.row[term] >= 0
        table = np.zeros((texts, len(self.dense)))
        table[owner[frequent], self.row[term[frequent]]] = value[frequent]
        owner, term, value = owner[~frequent], term[~frequent], value[~frequent]
        cut, size = _expanded(self.starts[term], self.starts[term + 1])
        owner, value, blocks = np.repeat(owner.astype(np.int64), size), np.repeat(value, size), self.dense_most.shape[1]
        meets = owner * blocks + self.block[cut]
        bound = table @ self.dense_most + np.bincount(meets, value * self.most[cut], texts * blocks).reshape(texts, blocks)
        bound = bound * (1 + 1e-9) + 1e-9
        sims, few = np.full((texts, n), -1.0), min(k + (skip is not None), n)
        wanted = np.zeros((texts, blocks), bool)
        np.put_along_axis(wanted, np.argpartition(-bound, min(FIRST, blocks) - 1, 1)[:, : min(FIRST, blocks)], True, 1)
        for again in (False, True):
            read = np.flatnonzero(wanted.ravel()[meets])
            posting, size = _expanded(self.first[cut[read]], self.first[cut[read] + 1])
            rare = np.bincount(np.repeat(owner[read] * n, size) + self.examples[posting], self.values[posting] * np.repeat(value[read], size), texts * n).reshape(texts, n)
            for b in np.flatnonzero(wanted.any(0)):
                rows, part = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, min((b + 1) * BLOCK, n))
                sims[rows, part] = np.round(table[rows] @ self.dense[:, part] + rare[rows, part], 12)
            if not again:
                wanted = ~wanted & (bound >= np.maximum(np.partition(sims, n - few, 1)[:, n - few], 1e-12)[:, None])
        if skip is not None:
            sims[skip[:, None] == self.ids[None, :]] = -1.0
        few = min(k, n)
        least = np.maximum(np.partition(sims, n - few, 1)[:, n - few], 1e-12)
        text, near = np.nonzero(sims >= least[:, None])
        score = sims[text, near]
        by = np.lexsort((self.ids[near], -score, text))
        text, near, score = text[by], near[by], score[by]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        text, near, score, rank = (v[rank < k] for v in (text, near, score, rank))
        best[text, rank], place[text, rank] = score, near
        return best, place

    def weights_of(self, x: tuple[np.ndarray, np.ndarray, np.ndarray], place: np.ndarray) -> np.ndarray:
        """Each neighbour's vote: the square of the sum of shared terms' products times relevance."""
        owner, term, value = x
        found, row = np.zeros(place.shape), np.zeros(len(self.weight))
        ends = np.searchsorted(owner, np.arange(len(place) + 1))
        for i, near in enumerate(place):
            near, mine = near[near >= 0], slice(ends[i], ends[i + 1])
            row[term[mine]] = value[mine]
            if len(near):
                parts = [slice(*x) for x in zip(self.own[near].tolist(), self.own[near + 1].tolist())]  # none is empty
                shares = row.take(np.concatenate([self.own_terms[p] for p in parts])) * np.concatenate([self.own_values[p] for p in parts])
                found[i, : len(near)] = np.add.reduceat(shares, np.cumsum([0, *(p.stop - p.start for p in parts[:-1])]))
            row[term[mine]] = 0
        return found**2 * np.where(self.labels[place] == 1, self.class_weight[1], self.class_weight[0]) if len(self.labels) else found

    def votes(self, weight: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Share of toxic neighbours by their votes, and of ``prior`` by all labels."""
        label = self.labels[place] if len(self.labels) else np.zeros(place.shape)
        return np.where((place < 0).all(1), self.base, ((weight * label).sum(1) + self.prior * self.share()) / (weight.sum(1) + self.prior))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        if self.steps is None:
            return np.clip(votes, 0, 1)
        return np.clip(np.interp(votes, *self.steps), 0, 1)


def _expanded(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges start[i] to end[i], and how many there are in each."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size), size


def _alike(x: tuple[np.ndarray, np.ndarray, np.ndarray], texts: int) -> np.ndarray:
    """A cluster of each text, by spherical k-means over hashed random projections to 32 dimensions."""
    rng = np.random.default_rng(3)
    owner, term, value = x
    signs = rng.choice([-1.0, 1.0], (4093, 32))
    low = np.stack([np.bincount(owner, value * signs[term % 4093, d], minlength=texts) for d in range(32)], 1)
    low /= np.maximum(np.linalg.norm(low, axis=1, keepdims=True), 1e-12)
    k = max(1, texts // BLOCK)
    centres = low[rng.choice(texts, k, replace=False)]
    own = np.zeros(texts, np.int64)
    for _ in range(6):
        own = np.argmax(low @ centres.T, 1)
        centres = np.stack([np.bincount(own, low[:, d], minlength=k) for d in range(32)], 1)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return own


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best non-decreasing fit of label on vote (pool adjacent violators), to be joined by lines."""
    points, own = np.unique(votes, return_inverse=True)  # equal votes are one point
    weight, mean = np.bincount(own, weights), np.bincount(own, weights * labels)
    pools: list[list[float]] = []  # weight, weighted vote, weighted label
    for v, w, y in zip(points, weight, mean):
        pools.append([w, w * v, y])
        while len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    w, v, y = np.array(pools).T
    return v / w, y / w


def examples(docs: DataFrame, labels: DataFrame, learned, per_class: int) -> DataFrame:
    """doc_id, label, text of at most ``per_class`` labelled documents of each class in order of a hash of the id, without those
    over LONGEST bytes, and only up to BYTES of a class."""
    sample = materialize(labelled_sample(docs, labels, "toxic", learned, per_class), "toxic-examples").filter(F.octet_length("text") <= LONGEST)
    ordered = Window.partitionBy("label").orderBy("h", "doc_id")  # per_class numbers each
    sizes = sample.groupBy("doc_id", "label").agg(F.sum(F.octet_length("text")).alias("bytes")).withColumn("h", F.xxhash64("doc_id"))
    few = sizes.withColumn("upto", F.sum("bytes").over(ordered)).filter(F.col("upto") <= BYTES).select("doc_id")
    return sample.join(F.broadcast(few), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, learned, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> Model:
    """Examples (see examples()), with all their terms. Document frequencies are counted over all documents."""
    sample = examples(docs, labels, learned, per_class)
    relevance = vocabulary(sample)
    counts, cells, n = document_counts(docs, relevance)
    model = Model(dict(zip(relevance, rarity(counts, n).tolist())), rarity(np.minimum(cells, n), n).astype(np.float32))
    relevance = np.array(list(relevance.values()))
    sizes = {r[0]: r[1] for r in labels.filter(learned & F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").cast("int")).count().collect()}
    drawn = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    whole = max(sum(sizes.values()), 1)
    model.class_weight = tuple(sizes.get(c, 0) / whole * (sum(drawn.values()) / drawn[c]) if drawn.get(c) else 0.0 for c in (0, 1))
    rows = sample.select("doc_id", "label", "text").orderBy("doc_id", "text").toArrow()  # 2 * BYTES at most
    ids, label = rows["doc_id"].to_numpy(), rows["label"].to_numpy().astype(float)
    parts = []  # a few at once and in short numbers, for the driver's memory
    for i in range(0, len(ids), TEXTS):
        owner, term, value = model.vectors(t.as_buffer().to_pybytes() for t in rows["text"][i : i + TEXTS])
        parts.append(((owner + i).astype(np.int32), term.astype(np.int32), value))
    x = tuple(np.concatenate(v) for v in zip(*parts)) if parts else model.vectors([])
    del parts, rows
    model.index(ids, x, label, relevance)
    if len(set(label)) == 2:
        found = []
        for i in range(0, len(ids), TEXTS):
            a, b = np.searchsorted(x[0], [i, i + TEXTS])
            part, number = (x[0][a:b] - i, x[1][a:b], x[2][a:b]), len(ids[i : i + TEXTS])
            near = model.nearest(number, part, k, ids[i : i + TEXTS])[1]
            found.append((model.weights_of(part, near), near))
        weight, near = (np.concatenate(v) for v in zip(*found))
        model.prior = max(PRIOR * float(np.median(weight.sum(1))), 1e-12)
        model.steps = isotonic(model.votes(weight, near), label, np.where(label == 1, model.class_weight[1], model.class_weight[0]))
    return model


EVIDENCE_TYPE = "array<struct<doc_id:long,similarity:double,toxic:int>>"


def score_toxicity(docs: DataFrame, model: Model, k: int = NEIGHBOURS) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, score (0 to 1), evidence (the EVIDENCE nearest examples); one row for each row.

    Texts without a term of any example, null and empty ones among them, have no neighbours: their score is the share of toxic ones
    among such examples. Equally similar examples count in order of their ids. Repeated rows and null ids pass; other columns are
    ignored. Without examples every score is 0; with those of one class, it is that class's share of the votes, uncalibrated.
    Texts are compared whole, slices of them at once: TEXTS of them or 2 million bytes, a longer text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            for a, b in text_slices(texts, max_texts=TEXTS):
                part = batch.slice(a, b - a)
                x = m.vectors(texts[a:b])
                best, place = m.nearest(b - a, x, k)
                score = m.calibrated(m.votes(m.weights_of(x, place), place))
                shown = place[:, :EVIDENCE] >= 0
                at = place[:, :EVIDENCE][shown]
                items = pa.StructArray.from_arrays([pa.array(m.ids[at]), pa.array(best[:, :EVIDENCE][shown]), pa.array(m.labels[at].astype(np.int32))], ["doc_id", "similarity", "toxic"])
                evidence = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(shown.sum(1))]), pa.int32()), items)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), evidence], ["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, f"doc_id long, score double, evidence {EVIDENCE_TYPE}")


def op5_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rest = crc_rest("doc_id", 4)
    scored = score_toxicity(docs, learn(docs, labels, rest != 2))
    return scored.select("doc_id", (rest == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")
