"""Encoding with spans against the library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from forecourt.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TEXTS = ["", " ", "   ", "a", " a  b ", "▁a ▁▁ b", "\x00x", "two\n\nlines \n x\n", "中文 𠀀😀 é é ﷺ ﬁ Ａ① ㍿", "</s> <s> <unk> <0x41>", "　 wide blank ", "﻿​ z­", "x" * 3000, "ab " * 2000, "\r\n\t", "ﬁ ﬁ́ ½ ™ 각"]


def with_map(rule: str | None, **spec) -> bytes:
    """The model's pieces under another normaliser."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    if rule:
        made = sentencepiece_model_pb2.ModelProto()
        made.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = made.normalizer_spec.precompiled_charsmap
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


MODELS = {
    "own": with_map(None),
    "nmt_nfkc": with_map("nmt_nfkc", remove_extra_whitespaces=True),
    "nfkc_cf": with_map("nfkc_cf"),
    "squeezed": with_map(None, remove_extra_whitespaces=True),
    "bare": with_map("nfkc", add_dummy_prefix=False),
    "unescaped": with_map(None, escape_whitespaces=False),
}


@pytest.fixture(scope="module", params=MODELS)
def both(request):
    return piece_codec.PieceCodec(MODELS[request.param]), sentencepiece.SentencePieceProcessor(model_proto=MODELS[request.param])


def check(codec, library, text):
    ids, begins, ends = codec.encode(text)
    assert ids.tolist() == library.encode(text), text
    assert codec.decode(ids.tolist()) == library.decode(library.encode(text))
    data = text.encode()
    spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
    assert spans == list(zip(begins.tolist(), ends.tolist())), text
    assert all(0 <= a <= b <= len(data) for a, b in zip(begins, ends))


def test_ids_and_spans_are_the_librarys(both):
    for text in TEXTS:
        check(*both, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from(" \n▁ 　aAeｆﬁ①é́中😀\x00"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_any_text(text):
    for codec, library in OPENED:
        check(codec, library, text)
        together = [text, text[::-1], "", text + " ", TEXTS[7]]
        assert [ids.tolist() for ids, _, _ in codec.encode_all(together)] == library.encode(together)


OPENED = [(piece_codec.PieceCodec(MODELS[k]), sentencepiece.SentencePieceProcessor(model_proto=MODELS[k])) for k in ("own", "nmt_nfkc")]


def test_character_map_applies_the_longest_rule():
    rules = OPENED[1][0].map.rules
    assert len(rules) > 1000 and rules["①"] == "1" and rules["ﬁ"] == "fi" and max(map(len, rules)) > 1
    longest = max(rules, key=len)
    for key in [longest, "①", "ﬁ"]:
        assert OPENED[1][0].map.longest((key + "zz").encode()) == (len(key.encode()), rules[key].encode())
    assert OPENED[1][0].map.longest(b"zz") == (0, b"") and OPENED[0][0].map.longest(b"zz") == (0, b"")


def test_query_against_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_eos=True)
        want[doc_id] = (len(ids), hexed(" ".join(map(str, ids))), hexed(library.decode(ids)), len((text or "").encode()))
    assert {r[0]: tuple(r[1:]) for r in piece_codec.op11_pieces(spark, SF).collect()} == want


def test_spans_give_the_text_back_and_ids_decode(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(3, None), (None, "no id"), (7, "again"), (7, "again")], "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("ids", "begins", "ends", "decoded")})
    coded = piece_codec.encode_documents(docs, PATH, decoded=True)
    rows = coded.collect()
    assert len(rows) == len(TEXTS) + 4
    for r in rows:
        assert r["ids"][-1] == 2 and r["begins"][0] == 0 and all(a == b for a, b in zip(r["ends"], r["begins"][1:]) if a != b) and r["ends"][-1] == r["begins"][-1]
    assert [tuple(r) for r in rows if r["doc_id"] == 3 and len(r["ids"]) == 1] == [(3, [2], [0], [0], "")]
    assert sorted(map(str, piece_codec.decode_documents(coded, PATH).collect())) == sorted(str(r).replace("decoded=", "text=") for r in coded.select("doc_id", "decoded").collect())
    assert piece_codec.encode_documents(docs.limit(0), PATH).count() == 0
    bare = piece_codec.encode_documents(docs.filter("doc_id = 0"), PATH, end=False).collect()
    assert [tuple(r) for r in bare] == [(0, [], [], [])]


def test_models_that_hide_what_unknown_pieces_cover_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODELS["own"])
    proto.pieces[500].type = sentencepiece_model_pb2.ModelProto.SentencePiece.USER_DEFINED
    with pytest.raises(ValueError):
        piece_codec.PieceCodec(proto.SerializeToString())
