"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are its own and, once more, those of the lines before and after it; forward-backward
gives each line's probability of being good within its document, and a document's score is their mean, weighted by length.

Labels are of documents: while learning, all lines of a document have its label. Changes from good to bad within one are thus never
seen, only that they are rarer than staying, which the regularised transition scores express.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_rest, in_slices, labelled_sample, text_or_empty
from .shingles import mix

#: Labelled documents of each class that the field is fitted on at most, and lines that one of them may have.
PER_CLASS, FIT_LINES = 1_500, 1_000
UPPER, LOWER, DIGIT, BLANK, OTHER = range(5)
_CLASS = None
_U = np.uint64


def _classes() -> np.ndarray:
    global _CLASS
    if _CLASS is None:
        _CLASS = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isupper():
                _CLASS[c] = UPPER
            elif ch.isalpha():
                _CLASS[c] = LOWER
            elif ch.isdigit():
                _CLASS[c] = DIGIT
            elif ch.isspace():
                _CLASS[c] = BLANK
    return _CLASS


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features), characters of each line, lines of each text. A text has one line more than line feeds."""
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    kind = _classes()[raw]
    feeds = raw == 10
    line = np.cumsum(feeds) - feeds
    n = int(feeds.sum())
    sizes = np.array([len(t) for t in texts])
    per_text = np.bincount(np.repeat(np.arange(len(texts)), sizes + 1)[feeds], minlength=len(texts))
    text_of_line = np.repeat(np.arange(len(texts)), per_text)
    counts = np.bincount(line * 5 + kind, minlength=n * 5).reshape(n, 5).astype(float)
    counts[:, BLANK] -= 1  # its line feed
    chars = counts.sum(1)
    inside = kind != BLANK
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~before)
    words = np.bincount(line[starts], minlength=n).astype(float)
    distinct, echoes, known = words.copy(), np.zeros(n), np.zeros(n)
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        place = np.arange(len(raw)) - np.concatenate([[0], np.flatnonzero(feeds)[:-1] + 1]).repeat(np.bincount(line, minlength=n)) if n else np.zeros(0)
        power = np.cumprod(np.full(int(place.max()) + 2 if n else 1, 0x9E3779B97F4A7C15, np.uint64))
        np.add.at(hashes, line, np.where(feeds, _U(0), raw.astype(np.uint64) * power[place.astype(np.int64)]))
        if len(starts):
            ends = np.flatnonzero(~inside & before)
            cum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(raw.astype(np.uint64) + _U(1)))])  # order within a word doesn't matter here
            token = mix(cum[ends] - cum[starts])
            owner = line[starts]
            order = np.lexsort((token, owner))
            t, o = token[order], owner[order]
            distinct = np.bincount(o[np.concatenate([[True], (t[1:] != t[:-1]) | (o[1:] != o[:-1])])], minlength=n).astype(float)
            echoes = np.bincount(owner[1:][(token[1:] == token[:-1]) & (owner[1:] == owner[:-1])], minlength=n).astype(float)
            text_of_word = text_of_line[owner]
            order = np.lexsort((token, text_of_word))
            t, o = token[order], text_of_word[order]
            first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (o[1:] != o[:-1])]))
            often = np.repeat(np.diff(np.append(first, len(t))), np.diff(np.append(first, len(t))))
            known = np.bincount(line[starts][order], often > 1, minlength=n).astype(float)
    order = np.lexsort((hashes, text_of_line))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text_of_line[order][1:] == text_of_line[order][:-1]) & (chars[order][1:] > 0)
    twin = np.zeros(n, bool)
    twin[order[1:][same]] = twin[order[:-1][same]] = True
    letters = counts[:, UPPER] + counts[:, LOWER]
    share = lambda a, b: a / np.maximum(b, 1)
    solid = chars - counts[:, BLANK]
    base = [share(counts[:, UPPER], letters), share(counts[:, DIGIT], solid), share(counts[:, OTHER], solid), share(counts[:, OTHER], words), share(distinct, words), share(echoes, words), share(known, words), twin.astype(float)]
    length = np.log1p(chars) / 5
    steps = [base[0] > 0.15, base[0] > 0.6, base[2] > 0.08, base[2] > 0.2, base[1] > 0.1, base[4] < 0.7, base[4] < 0.4, base[6] > 0.7, base[6] > 0.95, chars == 0, words <= 3]
    own = np.stack([*base, length, share(solid, words) / 8, *steps], 1)
    begins, ends_ = np.zeros(n, bool), np.zeros(n, bool)
    at = np.cumsum(per_text)
    begins[at - per_text] = True
    ends_[at - 1] = True
    prev, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    prev[begins] = 0
    after[ends_] = 0
    return np.concatenate([np.ones((n, 1)), own, prev, after, begins[:, None], ends_[:, None]], 1), chars, per_text


class Packed:
    """Lines of sequences in step order: of every step, first those of the longest sequences."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        first = (np.cumsum(lengths) - lengths)[order]
        steps = int(lengths.max()) if len(lengths) else 0
        active = np.searchsorted(-lengths[order], -np.arange(steps), "left")  # sequences longer than t
        self.rows = np.concatenate([np.zeros(0, np.int64), *(first[:n] + t for t, n in enumerate(active))])
        self.at = np.concatenate([[0], np.cumsum(active)]).astype(np.int64)

    def steps(self) -> int:
        return len(self.at) - 1


def _lse(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(x, y)


def forward_backward(e: np.ndarray, move: np.ndarray, packed: Packed) -> tuple[np.ndarray, np.ndarray, float]:
    """e: score of "good" of each packed line (bad: 0); move: 2 x 2 scores. P(good) of each line, the expected pairs (lines x 2 x 2, at the
    later line), and the sum of log Z."""
    n = packed.at
    alpha, beta = np.zeros((len(e), 2)), np.zeros((len(e), 2))
    pairs = np.zeros((len(e), 2, 2))
    emit = np.stack([np.zeros(len(e)), e], 1)
    for t in range(packed.steps()):
        a, b = n[t], n[t + 1]
        if t == 0:
            alpha[a:b] = emit[a:b]
        else:
            last = alpha[n[t - 1] : n[t - 1] + b - a]
            alpha[a:b] = emit[a:b] + np.stack([_lse(last[:, 0] + move[0, s], last[:, 1] + move[1, s]) for s in (0, 1)], 1)
    for t in range(packed.steps() - 2, -1, -1):
        a, m = n[t], n[t + 2] - n[t + 1]
        later = emit[n[t + 1] : n[t + 2]] + beta[n[t + 1] : n[t + 2]]
        beta[a : a + m] = np.stack([_lse(later[:, 0] + move[s, 0], later[:, 1] + move[s, 1]) for s in (0, 1)], 1)
    log_z = _lse(alpha[:, 0] + beta[:, 0], alpha[:, 1] + beta[:, 1])
    good = np.exp(alpha[:, 1] + beta[:, 1] - log_z)
    for t in range(1, packed.steps()):
        a, b = n[t], n[t + 1]
        last, z = alpha[n[t - 1] : n[t - 1] + b - a], log_z[a:b]
        for r in (0, 1):
            for s in (0, 1):
                pairs[a:b, r, s] = np.exp(last[:, r] + move[r, s] + emit[a:b, s] + beta[a:b, s] - z)
    return good, pairs, float(log_z[: n[1]].sum()) if packed.steps() else 0.0


@dataclass
class Field:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    move: np.ndarray

    def good(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        packed = Packed(per_text)
        e = ((features - self.mean) / self.spread) @ self.weights
        out = np.zeros(len(e))
        out[packed.rows] = forward_backward(e[packed.rows], self.move, packed)[0]
        return out


def fit(features: np.ndarray, per_text: np.ndarray, label: np.ndarray, rounds: int = 120) -> Field:
    """Conditional likelihood of each document's label on all its lines, each document counting alike, by Adam."""
    mean, spread = features.mean(0), features.std(0) + 1e-6
    mean[0], spread[0] = 0, 1
    packed = Packed(per_text)
    x = ((features - mean) / spread)[packed.rows]
    y = np.repeat(label, per_text)[packed.rows].astype(float)
    size = np.repeat(1 / per_text, per_text)[packed.rows]
    later = np.repeat(per_text, per_text)[packed.rows] > 0
    later[: packed.at[1]] = False
    seen = np.array([[((y == s) & later & (y == r)) * size for s in (0, 1)] for r in (0, 1)]).sum(2)
    w, move = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for i in range(1, rounds + 1):
        good, pairs, _ = forward_backward(x @ w, move, packed)
        slope = np.concatenate([x.T @ ((good - y) * size), ((pairs * size[:, None, None]).sum(0) - seen).ravel()]) / len(label)
        slope += 1e-3 * np.concatenate([w, move.ravel()])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        step = 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        w, move = w - step[:-4], move - step[-4:].reshape(2, 2)
    return Field(mean, spread, w, move)


def learn(docs: DataFrame, labels: DataFrame, learned, per_class: int = PER_CLASS) -> Field | None:
    """Fits the field on at most ``per_class`` labelled documents of each class, of up to FIT_LINES lines each. None
    where a class has no example."""
    sample = labelled_sample(docs, labels, "quality", learned, per_class).filter(F.regexp_count("text", F.lit("\n")) < FIT_LINES)

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        f, _, n = line_features(batch.column(0).to_pylist())
        at = np.cumsum(n)
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array([f[j - k : j].astype(np.float32).tobytes() for j, k in zip(at, n)], pa.binary()), pa.array(n, pa.int64())], ["label", "lines", "n"])

    rows = sample.select("text", "label").mapInArrow(in_slices(features, 0), "label int, lines binary, n long").toArrow().to_pydict()
    label = np.array(rows["label"])
    if len(set(label)) < 2:
        return None
    return fit(np.frombuffer(b"".join(rows["lines"]), np.float32).reshape(sum(rows["n"]), -1).astype(float), np.array(rows["n"]), label)


def score_quality(docs: DataFrame, model: Field | None) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, score (0 to 1), n_lines, n_bad_lines (P(good) < 0.5); one row for each row.

    Null and empty texts have one empty line and the score of that line. Repeated rows and null ids pass; other columns are ignored.
    Without a fitted model every line is 0.5. A task holds the texts of some 500,000 characters at once, or one longer text whole,
    with arrays of some 80 bytes a character and 600 a line.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        f, chars, n = line_features(batch.column(1).to_pylist())
        good = shared.value.good(f, n) if shared.value else np.full(len(f), 0.5)
        owner, weight = np.repeat(np.arange(len(n)), n), chars + 1
        total = np.bincount(owner, good * weight, minlength=len(n)) / np.bincount(owner, weight, minlength=len(n))
        bad = np.bincount(owner, good < 0.5, minlength=len(n)).astype(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(total, 0, 1)), pa.array(n), pa.array(bad)], ["doc_id", "score", "n_lines", "n_bad_lines"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(in_slices(step, 1), "doc_id long, score double, n_lines long, n_bad_lines long")


def op4_line_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rest = crc_rest("doc_id", 3)
    scored = score_quality(docs, learn(docs, labels, rest != 1))
    return scored.select("doc_id", (rest == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines", "n_bad_lines")
