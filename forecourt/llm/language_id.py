"""Language identification by error-correcting output codes.

Every language has a binary codeword. For each bit a linear classifier over hashed character n-grams (1 to 3, letters
only) tells the languages with a 1 there from those with a 0; all bits are log-odds of the same n-gram counts, summed
over all learned documents in one aggregation. Decoding is loss-weighted: a codeword's loss is the sum over bits of
weight * exp(-agreement), where the weights are how well a bit's classifier recognises that language on learned documents.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_rest, in_slices, text_or_empty, text_slices

UNKNOWN = "und"
#: Hash cells for n-grams of length 1 to 3 together.
CELLS = 8192
#: Labels that a model may learn at most unless the caller allows more; the counts of one are CELLS numbers on the driver.
LANGUAGES = 1024
#: Texts and characters that are counted at once: bounds the counts (texts x CELLS) and the arrays of characters.
TEXTS, CHARS = 128, 400_000
_FOLD = None


def _fold() -> np.ndarray:
    """Code point -> lower-case code point for letters, 0 for anything else (one space between words is enough)."""
    global _FOLD
    if _FOLD is None:
        _FOLD = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
                low = ch.lower()
                _FOLD[c] = ord(low) if len(low) == 1 else c
    return _FOLD


def ngram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x CELLS) and the number of letters of each text."""
    counts, letters = np.zeros((len(texts), CELLS), np.float32), np.zeros(len(texts), np.int64)
    for a, b in text_slices(texts, CHARS, TEXTS):
        raw = np.frombuffer("\0".join(["", *texts[a:b], ""]).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) + 1 for t in texts[a:b]])
        owner = np.concatenate([[0], np.repeat(np.arange(b - a), sizes)])
        owner = np.append(owner, b - a - 1)[: len(raw)]
        c = _fold()[raw].astype(np.uint64)
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] > 0) | (c[:-1] > 0)  # one gap between words
        c, owner = c[keep], owner[keep]
        letters[a:b] = np.bincount(owner, c > 0, minlength=b - a)
        flat = np.zeros((b - a) * CELLS)
        with np.errstate(over="ignore"):
            h = np.zeros(len(c), np.uint64)
            for n in range(3):
                h = h[: len(c) - n] * np.uint64(0x9E3779B97F4A7C15) + c[n:] + np.uint64(n + 1)
                starts, ends = c[: len(h)] > 0, c[n:] > 0
                # gaps are no one's: a run of characters belongs to its letters, and none reaches from one text into the next
                own = np.where(starts, owner[: len(h)], owner[n:])
                inside = (starts | ends) & ~(starts & ends & (owner[: len(h)] != owner[n:]))
                cell = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(51)
                flat += np.bincount((own * CELLS + cell.astype(np.int64))[inside], minlength=len(flat))
        counts[a:b] = flat.reshape(b - a, CELLS)
    return counts, letters


def codewords(languages: int) -> np.ndarray:
    """languages x bits of -1 and 1. Up to 7 languages: every way to part them in two; more: bits drawn at random, each
    balanced, with 8 bits for every doubling of the languages and 16 besides."""
    if languages <= 7:
        rows = np.array([[1 if (p >> i) & 1 else -1 for p in range(1, 2 ** max(languages - 1, 1))] for i in range(languages)])
        return rows if languages > 1 else np.ones((1, 1), int)
    bits, rng = 16 + 8 * int(np.ceil(np.log2(languages))), np.random.default_rng(11)
    return np.stack([rng.permutation(np.where(np.arange(languages) % 2, 1, -1)) for _ in range(bits)], 1)


@dataclass
class Model:
    labels: list[str]
    codes: np.ndarray
    odds: np.ndarray = field(default_factory=lambda: np.zeros((CELLS, 0), np.float32))  # cells x bits, log odds of a cell
    weights: np.ndarray | None = None  # languages x bits

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Mean log odds a n-gram, by bit; steep enough to be sure of a clear text."""
        return 4.0 * (counts @ self.odds) / np.maximum(counts.sum(1, keepdims=True), 1)

    def losses(self, counts: np.ndarray) -> np.ndarray:
        m = self.margins(counts)
        return np.stack([(w * np.exp(-np.clip(c * m, -30, 30))).sum(1) for c, w in zip(self.codes, self.weights)], 1)

    def decode(self, counts: np.ndarray, letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Label, score and distance to the second nearest codeword (relative). The score is the label's share when all
        codewords share 1 by exp(-loss * root of the number of letters)."""
        if not self.labels:
            return [UNKNOWN] * len(counts), np.zeros(len(counts)), np.zeros(len(counts))
        loss = self.losses(counts)
        order = np.sort(loss, 1)
        least, second = order[:, 0], order[:, min(1, order.shape[1] - 1)]
        gap = (second - least) / np.maximum(second, 1e-12) if len(self.labels) > 1 else np.ones(len(counts))
        shares = np.exp(-(loss - least[:, None]) * np.sqrt(np.maximum(letters, 1))[:, None])
        score = np.where(letters > 0, 1 / shares.sum(1), 0.0)
        best = loss.argmin(1)
        return [self.labels[i] if n else UNKNOWN for i, n in zip(best, letters)], score, np.where(letters > 0, gap, 0.0)


def _known(docs: DataFrame, learned) -> DataFrame:
    """lang and text of the rows to learn from."""
    return docs.filter(learned & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))


def learn(docs: DataFrame, learned, languages: int = LANGUAGES) -> Model:
    """docs(doc_id, text, lang, ...); ``learned`` is the condition on rows to learn from. All of them are counted, and the
    bits' weights are measured on all of them in a second pass. Labels' counts meet on the driver: the ``languages`` labels of most rows (of
    equal ones, the first by code point) are learned, and rows of others are not learned from."""
    known = _known(docs, learned)
    labels = sorted(r[0] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect())
    if not labels:
        return Model([], np.zeros((0, 0)))
    known = known.filter(F.col("lang").isin(labels))
    number = {label: i for i, label in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def step(batch: pa.RecordBatch) -> None:
            langs, (counts, _) = np.array(batch.column(0).to_pylist(), dtype=object), ngram_counts(batch.column(1).to_pylist())
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + counts[langs == lang].sum(0, dtype=np.float64)

        deque(in_slices(step, 1, CHARS, TEXTS)(batches), 0)
        rows = [(lang, c, v[c]) for lang, v in sums.items() for c in np.flatnonzero(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], ["lang", "cell", "n"])

    # one row for each language and cell: LANGUAGES * CELLS at most
    totals = known.mapInArrow(count, "lang string, cell int, n double").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    by = np.zeros((len(labels), CELLS))
    by[[number[x] for x in totals["lang"].to_pylist()], totals["cell"].to_numpy()] = totals["n"].to_numpy()
    share = (by + 0.05) / (by + 0.05).sum(1, keepdims=True)  # every language counts alike, however many documents it has
    codes = codewords(len(labels))
    model = Model(labels, codes)
    one, zero = (codes > 0).astype(float), (codes < 0).astype(float)
    model.odds = (np.log(share.T @ one / np.maximum(one.sum(0), 1) + 1e-12) - np.log(share.T @ zero / np.maximum(zero.sum(0), 1) + 1e-12)).astype(np.float32)
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(codes.shape), np.zeros(len(labels))

        def step(batch: pa.RecordBatch) -> None:
            own = np.array([number[x] for x in batch.column(0).to_pylist()], int)
            np.add.at(right, own, model.margins(ngram_counts(batch.column(1).to_pylist())[0]) * codes[own] > 0)
            np.add.at(seen, own, 1)

        deque(in_slices(step, 1, CHARS, TEXTS)(batches), 0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(labels)), pa.int32()), pa.array(list(right), pa.list_(pa.float64())), pa.array(seen, pa.float64())], ["language", "right", "seen"])

    right, seen = np.zeros(codes.shape), np.zeros(len(labels))
    for r in known.mapInArrow(judge, "language int, right array<double>, seen double").groupBy("language").agg(*[F.sum(F.get("right", F.lit(b))).alias(f"b{b}") for b in range(codes.shape[1])], F.sum("seen")).collect():
        right[r[0]], seen[r[0]] = r[1:-1], r[-1]
    model.weights = (right + 1) / (seen[:, None] + 2)
    model.weights /= model.weights.sum(1, keepdims=True)
    return model


#: Under this relative distance between the two nearest codewords a text is called ambiguous.
AMBIGUOUS = 0.02


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, lang_pred, score (0 to 1), gap, ambiguous; one row for each row.

    Null text, and text without a letter: "und", score 0. Repeated rows and null ids pass, other columns are ignored. Without a
    learned language every row is "und".
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores, gaps = shared.value.decode(*ngram_counts(batch.column(1).to_pylist()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores), pa.array(gaps)], ["doc_id", "lang_pred", "score", "gap"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(in_slices(step, 1, CHARS, TEXTS), "doc_id long, lang_pred string, score double, gap double")
    return found.withColumn("ambiguous", (F.col("lang_pred") != UNKNOWN) & (F.col("gap") < AMBIGUOUS))


def loss_limit(docs: DataFrame, model: Model, learned) -> float:
    """The least loss up to which a text counts as of a learned language: half way between the largest one of learned documents
    that decode to their own language, and 1, the loss of a text whose n-grams say nothing. Measured on all of
    them."""
    if not model.labels:
        return float("inf")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, (counts, letters) = shared.value, ngram_counts(batch.column(1).to_pylist())
        loss = m.losses(counts)
        right = (letters > 0) & (np.array([m.labels[i] for i in loss.argmin(1)], object) == np.array(batch.column(0).to_pylist(), object))
        return pa.RecordBatch.from_arrays([pa.array([float(loss.min(1)[right].max(initial=0.0))])], ["worst"])

    worst = _known(docs, learned).mapInArrow(in_slices(step, 1, CHARS, TEXTS), "worst double").agg(F.max("worst")).first()[0]
    shared.destroy()
    return (min(worst or 0.0, 1.0) + 1.0) / 2


def keep_identified(docs: DataFrame, model: Model, limit: float = float("inf")) -> DataFrame:
    """docs without the rows of which no language is known: null, no letter, or a least loss over ``limit``; ambiguous ones
    stay, for they are near to a learned language. Where one language was learned, whose loss tells nothing, all rows with a
    letter stay; where none was, all rows. All columns pass."""
    if not model.labels:
        return docs
    limit = limit if len(model.labels) > 1 else float("inf")
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, letters = ngram_counts([t or "" for t in batch.column(at).to_pylist()])
        return batch.filter(pa.array((letters > 0) & (shared.value.losses(counts).min(1) <= limit)))

    return docs.mapInArrow(in_slices(step, at, CHARS, TEXTS), docs.schema)


def op1_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rest = crc_rest("doc_id", 3)
    return predict(docs, learn(docs, rest != 1)).select("doc_id", (rest == 1).alias("held_out"), "lang_pred", "score", "gap", "ambiguous")
