"""Exact token counts at every prefix of a text, by dynamic programming over the places no token reaches across.

In the sentencepiece BPE models this module accepts, no piece holds a space mark behind another character, and none
holds a line feed. A merge therefore never crosses the start of a space run or either side of a line feed, and

    count(prefix) = count(prefix up to the last such cut) + count(what follows it)

holds exactly. The table of a text stores the count at every cut; the second term depends on one segment (a word with
its leading blanks) only. Segments recur, so each is encoded once a task while it stays in the memo.

Within a segment the same holds from token to token: every run of tokens of an encoding is itself an encoding, so

    count(s[:i]) = count(s[:k]) + 1, where s[k:i] is the last token of s[:i]

and s[k:i] is that token if and only if it stays apart from the last token of s[:k] when both are encoded together. One pass gives the
count at every character; no prefix is encoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MARK = "▁"
_SEGMENT = re.compile(f"\n[^ {MARK}\n]*|[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+")
#: Segments, and pairs of tokens, remembered by a task; at this many the memo starts anew. Segments of more characters aren't
#: remembered, so the memo stays under some 100 MB.
MEMO, MEMO_CHARS = 300_000, 48


def _model_can_be_cut(sp: sentencepiece.SentencePieceProcessor) -> bool:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(sp.serialized_model_proto())
    norm, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces
    bpe = model.trainer_spec.model_type == model.trainer_spec.BPE and not model.trainer_spec.treat_whitespace_as_suffix
    crossing = re.compile(f"[^{MARK}]{MARK}|\n")
    return plain and bpe and not any(p.type == kinds.USER_DEFINED or p.type == kinds.NORMAL and crossing.search(p.piece) for p in model.pieces)


class PrefixCounter:
    """Token counts under one sentencepiece model, as its encode() gives them without extra tokens."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if not _model_can_be_cut(self.sp):
            raise ValueError("this model's pieces can reach across blanks or line feeds; its prefixes can't be cut there")
        self.memo = _Memo(self.sp)
        self.scores = {self.sp.id_to_piece(i): self.sp.get_score(i) for i in range(self.sp.get_piece_size()) if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i) or self.sp.is_unused(i))}
        self.longest_piece = max(map(len, self.scores), default=1)
        self.apart: dict[tuple[str, str], bool] = {}

    @staticmethod
    def segments(text: str) -> list[str]:
        return _SEGMENT.findall(text)

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Cuts: prefix lengths in characters, and the exact count of each such prefix; the last is the whole text."""
        segments = _SEGMENT.findall(text)
        if not segments:
            return np.zeros(1, np.int64), np.zeros(1, np.int64)
        counts = self._counts(segments)
        return np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments))), np.cumsum(counts)

    def _counts(self, segments: list[str]) -> np.ndarray:
        counts = np.fromiter(map(self.memo.__getitem__, segments), np.int64, len(segments))
        counts[0] = len(self.sp.encode(segments[0]))
        if len(self.memo) > MEMO:
            self.memo.clear()
        return counts

    def total(self, text: str) -> int:
        return int(self.table(text)[1][-1])

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text: of all neighbours that make a piece, those with the best score are joined, the first of equals."""
        parts = list(text)
        while len(parts) > 1:
            joins = [(self.scores.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            score, i = max(((s, -i) for s, i in joins if s is not None), default=(None, 0))
            if score is None:
                break
            parts[-i : -i + 2] = [parts[-i] + parts[-i + 1]]
        return parts

    def _stay_apart(self, a: str, b: str) -> bool:
        key = (a, b)
        if key not in self.apart:
            if len(self.apart) >= MEMO:
                self.apart.clear()
            self.apart[key] = self.merged(a + b) == ([a, b] if a else [b])
        return self.apart[key]

    def within(self, segment: str, first: bool) -> np.ndarray:
        """Counts of every prefix of one segment, lengths 1 to len(segment), as it stands in a text."""
        s = MARK * first + segment.replace(" ", MARK)
        count, last = np.zeros(len(s) + 1, np.int64), [""] * (len(s) + 1)
        for i in range(1, len(s) + 1):
            for k in range(max(0, i - self.longest_piece), i):
                token = s[k:i]
                if (token in self.scores or k == i - 1) and self._stay_apart(last[k], token):
                    last[i] = token
                    count[i] = count[k] + (1 if token in self.scores else len(token.encode()))  # unknown characters are bytes
                    break
        return count[1 + first :]

    def every_prefix(self, text: str) -> np.ndarray:
        """The count of text[:j] for every j from 0 to len(text)."""
        segments, (_, counts) = _SEGMENT.findall(text), self.table(text)
        rows = [self.within(s, i == 0) + (counts[i - 1] if i else 0) for i, s in enumerate(segments)]
        return np.concatenate([[0], *rows]).astype(np.int64)

    def longest(self, text: str, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens."""
        lengths, counts = self.table(text)
        k = int(np.searchsorted(counts, budget, "right"))
        if k == len(counts):
            return len(text)
        start, base = (int(lengths[k - 1]), int(counts[k - 1])) if k else (0, 0)
        fits = np.flatnonzero(base + self.within(text[start : int(lengths[k])], k == 0) <= budget)
        return start + (int(fits[-1]) + 1 if len(fits) else 0)


class _Memo(dict):
    """Tokens of a segment that doesn't start its text. encode() puts one space mark before what it gets."""

    def __init__(self, sp):
        super().__init__()
        self.encode = sp.encode

    def __missing__(self, segment: str) -> int:
        if segment[0] == "\n":
            n = len(self.encode(segment)) - 1
        else:
            n = len(self.encode(segment[1:])) or 1
        if len(segment) <= MEMO_CHARS:
            self[segment] = n
        return n


def count_tokens(docs: DataFrame, model_path: str, cuts: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_bytes, n_tokens and, with cuts, cut_chars and cut_tokens (arrays): the
    prefix table, from which truncated_length() and budgets are answered.

    Null text counts as empty: no bytes, no tokens, one cut at 0. Repeated rows and null ids are kept as they are,
    other columns are ignored. No shuffle; a task holds one text and a bounded memo.
    """
    schema = "doc_id long, n_bytes long, n_tokens long" + ", cut_chars array<int>, cut_tokens array<int>" * cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(model_path)
        for batch in batches:
            tables = [counter.table(text) for text in map(pa.StringScalar.as_py, batch.column(2))] if cuts else None
            totals = [int(t[1][-1]) for t in tables] if cuts else [int(counter.table(text)[1][-1]) for text in map(pa.StringScalar.as_py, batch.column(2))]
            columns = [batch.column(0), batch.column(1), pa.array(totals, pa.int64())]
            if cuts:
                columns += [pa.array([t[i] for t in tables], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "cut_chars", "cut_tokens"][: len(columns)])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(run, schema)


def truncate(docs: DataFrame, model_path: str, budget: int) -> DataFrame:
    """doc_id, text cut to its longest prefix of at most ``budget`` tokens, n_tokens of the whole text."""

    def run(batches):
        counter = PrefixCounter(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t[: counter.longest(t, budget)] for t in texts], pa.string()), pa.array([counter.total(t) for t in texts], pa.int64())], ["doc_id", "text", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, text string, n_tokens long")


def op3_token_counts(spark, sf_dir, model_path: str | None = None, limit: int = 4096):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = count_tokens(docs, model_path or public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
