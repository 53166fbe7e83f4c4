"""SentencePiece: ids, spans and texts equal to the sentencepiece library; the normaliser equal to the library's with its
own compiled map and alignment."""

import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import piece
from kestrel.llm.queries import op13_sentencepiece_roundtrip

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
SF = "/root/testdata/sf0.001"

AWKWARD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "  a   b  ", "▁", "a▁b", "▁▁ ▁", " ▁a", "\0", "a\0b\0", "héllo 𐍈 x  ▁y", "日本語 テスト 🙂👩‍👩‍👧",
    "</s> <s><unk> <0x0A>\n\n\t\r", "a b　c", "x" * 5000, "ab" * 3000 + "  ", "naïve café — 1²３Ⅳ", "áë", "�", "\U0010ffff",
    "word " * 20_000, "𐍈" * 1000, "the▁the  " * 3000,
]


def want(text):
    proto = LIB.encode(text or "", return_type="proto")
    n = len((text or "").encode())
    return [*LIB.encode(text or ""), 2], [*[p.begin for p in proto.pieces], n], [*[p.end for p in proto.pieces], n]


def check(texts):
    model = piece._model(PATH)
    ids, begins, ends = model.encode(pa.array(texts, pa.string()), end=True)
    for t, *got, back in zip(texts, ids.to_pylist(), begins.to_pylist(), ends.to_pylist(), model.decode(ids).to_pylist(), strict=True):
        assert tuple(got) == tuple(want(t)), t
        assert back == LIB.decode(got[0])


def test_awkward_texts_equal_the_library(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(AWKWARD)], "doc_id long, text string, extra string").repartition(3)
    codec = piece.prepare(df, PATH)
    out = piece.decode(piece.encode(df, codec, end=True), codec).collect()
    assert len(out) == len(AWKWARD)
    for r in out:
        assert (r.ids, r.begins, r.ends) == tuple(want(AWKWARD[r.doc_id])), AWKWARD[r.doc_id]
        assert r.extra == "x" and r.decoded == LIB.decode(r.ids)
    # without the end id, whole batches of empty texts and of none
    for texts in ([None, ""], []):
        ids, begins, ends = piece._model(PATH).encode(pa.array(texts, pa.string()))
        assert ids.to_pylist() == begins.to_pylist() == ends.to_pylist() == [[]] * len(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé1! \n\t▁𐍈 日the\0", max_size=60), max_size=5))
def test_random_texts_equal_the_library(texts):
    check(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_texts_equal_the_library(texts):
    check([t.encode("utf-8", "replace").decode() for t in texts])


def test_every_code_point_equals_the_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"{c} a{c}" for c in points[i : i + 2048]) for i in range(0, len(points), 2048)]
    ids, _, _ = piece._model(PATH).encode(pa.array(texts), end=True)
    assert ids.to_pylist() == LIB.encode(texts, add_eos=True)


@pytest.mark.parametrize("ids", [[], [2], [1, 259, 2], [0, 5, 259], [3 + 0xE2, 3 + 0x82, 1000], [259, 259], [3 + 0xF0, 28705, 3 + 0x90], [28705, 28705],
                                 [1, 3 + 0xC3, 3 + 0xA9, 28705], [1, 2, 28705, 0, 1, 28705]])
def test_decoding_any_ids_equals_the_library(spark, ids):
    got = piece._model(PATH).decode(pa.array([ids, [], ids], pa.list_(pa.int32()))).to_pylist()
    assert got == [LIB.decode(ids), "", LIB.decode(ids)]


def test_null_ids_and_clash(spark):
    df = spark.createDataFrame([(1, None), (2, [264])], "doc_id long, ids array<int>")
    codec = piece.prepare(df, PATH)
    assert {r.doc_id: r.decoded for r in piece.decode(df, codec).collect()} == {1: "", 2: LIB.decode([264])}
    with pytest.raises(ValueError):
        piece.encode(spark.createDataFrame([(1, "a")], "ends long, text string"), codec)
    assert piece.encode(spark.createDataFrame([], "doc_id long, text string"), codec).count() == 0


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("fold", [True, False])
def test_normaliser_follows_the_compiled_map(rule, fold):
    """The library's own maps: text and alignment (it counts characters of the original, without the mark in front)."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=fold)
    own = piece.CharMap(lib.serialized_normalizer_spec())
    own.fold, own.prefix, own.space = fold, True, piece.MARK_BYTES
    rng = random.Random(7)
    texts = ["", " ", "  a  b ", "ｶﾞＡ  ①é ﬁ", "Straße　ｘ\t\n", "é́ 각 ㌀ ﷺ", "​﻿x"]
    texts += ["".join(rng.choice("aBé ①ｶﾞﾊﾟ 　ﬁ日é ㌔") for _ in range(rng.randrange(30))) for _ in range(300)]
    for text in texts:
        made, source = own.normalize(text.encode())
        want_text, want_source = lib.normalize(text, with_offsets=True)
        assert made.decode() == want_text, text
        upto = [len(text.encode()[:b].decode("utf-8", "ignore")) for b in source.tolist()]
        starts = [i for i, b in enumerate(made) if b & 0xC0 != 0x80] + [len(made)]
        assert [upto[i] for i in starts] == list(want_source), text


def test_spans_of_a_mapped_text():
    """A model with a map: pieces point at the bytes they were made from."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=False)
    model = piece.PieceModel(open(PATH, "rb").read())
    model.map = piece.CharMap(lib.serialized_normalizer_spec())
    model.map.fold, model.map.prefix, model.map.space = False, True, piece.MARK_BYTES
    texts = ["ﬁne ① Ａ㌔x", "plain", "", "𐍈①"]
    ids, begins, ends = model.encode(pa.array(texts))
    plain = piece._model(PATH)
    for t, i, b, e in zip(texts, ids.to_pylist(), begins.to_pylist(), ends.to_pylist()):
        normal = lib.normalize(t).replace("▁", " ")[1:]
        assert i == LIB.encode(normal) == plain.encode(pa.array([normal]))[0].to_pylist()[0]
        assert b[:1] in ([], [0]) and e[-1:] in ([], [len(t.encode())]) and all(x <= y for x, y in zip(b, e))
    raw = texts[0].encode()
    assert raw[begins[0][0].as_py() : ends[0][0].as_py()].decode().startswith("ﬁ")


def test_query_on_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op13_sentencepiece_roundtrip(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        ids, _, ends = want(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.spans_sha256 == hashlib.sha256(" ".join(map(str, ends)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
