"""Sentencepiece encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at every place the longest rule that starts there is applied, and for
every byte of the result the byte of the text it came from is recorded. The normalised text is cut where no piece can reach across, each
cut-out part is encoded once a task, and the record of sources turns the pieces' places in the normalised text into byte spans of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, text_or_empty

MARK = "▁"
#: Parts remembered: at this many those not used since the last such time are forgotten. Longer parts aren't remembered, so all stay
#: under some 250 MB.
MEMO, MEMO_CHARS = 500_000, 48
_PART = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


class CharacterMap:
    """A compiled map: a double array over UTF-8 bytes whose values point at strings that end with a zero byte. An empty one has no rules."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
        self.strings = blob[4 + size :]

    @staticmethod
    def _step(unit):
        """What a unit's place is combined with to reach its children."""
        return (unit >> 10) << ((unit >> 6) & 8)

    def _string(self, at: int) -> bytes:
        return self.strings[at : self.strings.index(b"\0", at)]

    def longest(self, data: bytes) -> tuple[int, bytes]:
        """Bytes that the longest rule at the start of data consumes (0: none starts there), and what it puts in their place."""
        units, at, found = self.units, 0, (0, -1)
        if len(units):
            at = self._step(int(units[0]))
        for n, byte in enumerate(data, 1):
            at ^= byte
            if at >= len(units) or int(units[at]) & 0x800000FF != byte:
                break
            unit = int(units[at])
            at ^= self._step(unit)
            if unit >> 8 & 1:
                found = n, int(units[at]) & 0x7FFFFFFF
        return (found[0], self._string(found[1])) if found[0] else (0, b"")

    @cached_property
    def rules(self) -> dict[str, str]:
        """Every rule, read level by level from the double array."""
        found: dict[str, str] = {}
        if not len(self.units):
            return found
        at, keys = np.array([self._step(int(self.units[0]))]), [b""]
        labels = np.arange(1, 256)
        while len(keys):
            child = at[:, None] ^ labels
            units = np.where(child < len(self.units), self.units[np.minimum(child, len(self.units) - 1)], 0)
            rows, columns = np.nonzero((units & 0x800000FF) == labels)
            units, child = units[rows, columns], child[rows, columns]
            keys = [keys[r] + bytes([c + 1]) for r, c in zip(rows.tolist(), columns.tolist())]
            at = child ^ self._step(units)
            for i in np.flatnonzero(units >> 8 & 1).tolist():
                found[keys[i].decode()] = self._string(int(self.units[at[i]]) & 0x7FFFFFFF).decode()
        return found

    @cached_property
    def places(self) -> re.Pattern | None:
        """Where a rule can start: at a character that is a rule, or before one that stands second in a rule."""
        single = "".join(re.escape(k) for k in self.rules if len(k) == 1)
        second = "".join(sorted({re.escape(k[1]) for k in self.rules if len(k) > 1}))
        either = ([f"[{single}]"] if single else []) + ([f".(?=[{second}])"] if second else [])
        return re.compile("|".join(either), re.DOTALL) if either else None

    def blanks(self, text: str) -> int:
        """Bytes at the start of the text that come out as single blanks."""
        most, done, at = max(map(len, self.rules), default=1), 0, 0
        while at < len(text):
            data = text[at : at + most].encode()
            n, put = self.longest(data)
            if not n:
                n, put = 1, data[:1]
            if put != b" ":
                break
            done, at = done + n, at + len(data[:n].decode())
        return done

    def apply(self, text: str) -> tuple[bytes, np.ndarray]:
        """The text under the map, and for each of its bytes, and for its end, the byte of the text it came from."""
        if not self.places:
            plain = text.encode()
            return plain, np.arange(len(plain) + 1, dtype=np.int32)
        most = max(map(len, self.rules))
        out, sources, at, begin = [], [], 0, 0  # at: characters done, begin: their bytes

        def keep(end: int) -> None:
            nonlocal at, begin
            run = text[at:end].encode()
            out.append(run)
            sources.append(np.arange(begin, begin + len(run), dtype=np.int32))
            at, begin = end, begin + len(run)

        for place in self.places.finditer(text):
            if place.start() < at:
                continue
            n, put = self.longest(text[place.start() : place.start() + most].encode())
            if n:
                keep(place.start())
                out.append(put)
                sources.append(np.full(len(put), begin, np.int32))
                at += len(text[at : at + most].encode()[:n].decode())
                begin += n
        keep(len(text))
        return b"".join(out), np.concatenate([*sources, [begin]]).astype(np.int32)


class PieceCodec:
    """encode() and decode() of one BPE model with byte fallback, with spans. Models with user-defined pieces, or without byte fallback, are
    refused: their unknown pieces don't tell what they cover."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds, trained = sentencepiece_model_pb2.ModelProto.SentencePiece, proto.trainer_spec
        if trained.model_type != trained.BPE or not trained.byte_fallback or any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("only BPE models with byte fallback and without user-defined pieces")
        norm = proto.normalizer_spec
        self.map = CharacterMap(norm.precompiled_charsmap)
        if norm.remove_extra_whitespaces and any("  " in v for v in self.map.rules.values()):
            raise ValueError("a rule puts two blanks")
        self.squeeze, self.escape = norm.remove_extra_whitespaces, norm.escape_whitespaces
        before = norm.add_dummy_prefix and not trained.treat_whitespace_as_suffix
        mark = MARK if self.escape else " "
        self.prefix, self.suffix = (mark if before else "").encode(), (mark if norm.add_dummy_prefix and not before else "").encode()
        crossing = re.compile(f"[^{MARK}]{MARK}|\n")
        self.cut = self.escape and not trained.treat_whitespace_as_suffix and not any(p.type == kinds.NORMAL and crossing.search(p.piece) for p in proto.pieces)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end_id = self.library.eos_id()
        bytes_of = [-1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces]
        norm.Clear()  # the same pieces over text that is normalised already
        norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
        self.memo = _Memo(sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), bytes_of, self.cut)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the byte of the text it came from."""
        data, source = self.map.apply(text)
        begin = 0
        if self.squeeze:
            data, source = _squeezed(data, source)
            begin = self.map.blanks(text)
        if not data:
            return "", source[-1:]
        blank = np.frombuffer(data, np.uint8) == 32
        if self.escape:
            data = data.replace(b" ", MARK.encode())
            source = np.repeat(source, np.append(np.where(blank, 3, 1), 1))
        source = np.concatenate([np.full(len(self.prefix), begin, np.int32), source[:-1], np.full(len(self.suffix) + 1, source[-1], np.int32)])
        return (self.prefix + data + self.suffix).decode(), source

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """encode() of each; parts that aren't remembered are encoded together."""
        normalised = [self.normalise(text) for text in texts]
        parts = [_PART.findall(text) if self.cut else [text] if text else [] for text, _ in normalised]
        pairs = self.memo.of(list(chain.from_iterable(parts)))
        at = 0
        for found, (_, source) in zip(parts, normalised):
            both = np.frombuffer(b"".join(pairs[at : at + len(found)]), np.int32).reshape(-1, 2)
            at += len(found)
            stop = np.cumsum(both[:, 1], dtype=np.int64)
            yield both[:, 0], source[stop - both[:, 1]], source[stop]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in the text's bytes each piece begins and ends. Of the pieces of a character that is spelt in bytes the last
        spans it, those before are empty."""
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


class _Memo:
    """A part of a normalised text -> its ids, each with the bytes it covers, as pairs of four-byte numbers."""

    def __init__(self, pieces: sentencepiece.SentencePieceProcessor, bytes_of: list[int], cut: bool):
        self.pieces, self.bytes_of, self.cut = pieces, np.array(bytes_of, np.int32), cut
        self.used: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def of(self, parts: list[str]) -> list[bytes]:
        """The pairs of each of these parts."""
        if len(self.used) > MEMO:
            self.before, self.used = self.used, {}
        found = list(map(self.used.get, parts))
        at = [i for i, pairs in enumerate(found) if pairs is None]
        if at:
            missing = set(map(parts.__getitem__, at))
            kept = {p: self.before[p] for p in missing & self.before.keys()}
            new = list(missing - kept.keys())
            if new:
                kept.update(zip(new, self._encoded(new)))
            for i in at:
                found[i] = kept[parts[i]]
            for long in [p for p in new if len(p) > MEMO_CHARS]:
                del kept[long]
            self.used |= kept
        return found

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """The parts of a model that can be cut are encoded in one go with line feeds between them, which join with nothing."""
        if not self.cut:
            return [self._pairs(p).tobytes() for p in parts]
        pairs = self._pairs("\n".join(parts))
        ends = np.cumsum([len(p.encode()) + 1 for p in parts]) - 1
        stops = np.searchsorted(np.cumsum(pairs[:, 1]), ends) + 1
        whole, stops = pairs.tobytes(), (8 * stops).tolist()
        return [whole[a:b] for a, b in zip([0, *[b + 8 for b in stops]], stops)]

    def _pairs(self, text: str) -> np.ndarray:
        ids = np.array(self.pieces.encode(text), np.int32)
        sizes = self.bytes_of[ids]
        if (sizes < 0).any():
            self._spell(text.encode(), sizes)
        return np.stack([ids, sizes], 1)

    @staticmethod
    def _spell(data: bytes, sizes: np.ndarray) -> None:
        """Gives the pieces of a character in bytes their sizes: its last one all of it, the others none."""
        at = done = 0  # bytes, pieces
        for i in np.flatnonzero(sizes < 0).tolist():
            if i < done:
                continue
            at += int(sizes[done:i].sum())
            n = 1 + sum(data[at] >= low for low in (0xC0, 0xE0, 0xF0))
            sizes[i : i + n] = 0
            sizes[i + n - 1] = n
            at, done = at + n, i + n


def _squeezed(data: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blanks at both ends gone, of others in a row only the first kept."""
    raw = np.frombuffer(data, np.uint8)
    blank = raw == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    if len(at) and blank[at[-1]]:
        end, at = source[at[-1]], at[:-1]
    else:
        end = source[-1]
    return raw[at].tobytes(), np.append(source[at], end).astype(np.int32)


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, with its memo, kept for later tasks of a worker."""
    if path not in _codecs:
        with open(path, "rb") as f:
            _codecs[path] = PieceCodec(f.read())
    return _codecs[path]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]), pa.int32()))


def encode_documents(docs: DataFrame, model_path: str, end: bool = True, decoded: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, ids, begins, ends (arrays of one length: a piece's id and its bytes in the text) and, with
    ``decoded``, the text that decode() makes of the ids. ``end`` adds the end id, at the end of the text.

    Null text counts as empty: no piece but the end id. Repeated rows and null ids come back as they are, other columns are ignored. Texts
    are whole and under 2 GB; a task holds a slice of a batch (some 500,000 characters, or one longer text) and a bounded memo. No shuffle.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = codec(model_path)
        ids, begins, ends, texts = [], [], [], []
        whole = batch.column(1).to_pylist()
        for n, found in zip(pc.binary_length(batch.column(1)).to_pylist(), pieces.encode_all(whole)):
            if end:
                found = [np.append(a, b).astype(np.int32) for a, b in zip(found, (pieces.end_id, n, n))]
            for kept, array in zip((ids, begins, ends), found):
                kept.append(array)
            if decoded:
                texts.append(pieces.decode(found[0].tolist()))
        columns = [batch.column(0), _lists(ids), _lists(begins), _lists(ends), *([pa.array(texts, pa.string())] if decoded else [])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "begins", "ends", "decoded"][: len(columns)])

    schema = "doc_id long, ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(in_slices(step, 1), schema)


def decode_documents(rows: DataFrame, model_path: str) -> DataFrame:
    """rows(doc_id, ids, ...) -> doc_id, text: what decode() makes of the ids. Null ids count as none."""

    def run(batches):
        for batch in batches:
            texts = [codec(model_path).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def op11_pieces(spark, sf_dir, model_path: str | None = None):
    """Also n_bytes, how far the last piece reaches: the bytes of the text."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    coded = encode_documents(docs, model_path or public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"), F.element_at("ends", -1).cast("long").alias("n_bytes"))
