"""BPE: equal to the tokenizers library on random and awkward texts, lossless, and independent of the lexicon."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kestrel.llm import bpe, lexicon, merges
from kestrel.llm.queries import op3_bpe_roundtrip

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"

AWKWARD = [
    None, "", " ", "   ", "a", "the the the", "it's we're I'll 'd x'VE", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>",
    "\t\n\r\x0b\x0c \x85\xa0  　x", "\x1c\x1d\x00\x01", "naïve café — 東京 🙂👩‍👩‍👧 1²３Ⅳ", "x" * 5000, "ab" * 3000 + "  ",
    "لغة ಕನ್ನಡ ไทย", "line\n\n\n  indented\t\ttabs ", "!!!???...", "áë", "�",
]


@pytest.fixture(scope="module")
def codec(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return bpe.prepare(df, PATH, lexicon_size=2000)


def _ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def test_awkward_texts_equal_the_library(spark, codec):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(AWKWARD)], "doc_id long, text string, extra string")
    out = bpe.decode(bpe.encode(df, codec), codec).collect()
    assert len(out) == len(AWKWARD)
    for r in out:
        want = _ids(AWKWARD[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == want, AWKWARD[r.doc_id]
        assert r.n_tokens == len(want) and r.extra == "x"
        assert r.decoded == LIB.decode(want, skip_special_tokens=False) == (AWKWARD[r.doc_id] or "")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_split_and_merge_equal_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    model = bpe._bpe(PATH)
    got = [i for w in bpe.splitter().findall(text) for i in model.merge(w.encode())]
    assert got == _ids(text)


def test_query_on_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op3_bpe_roundtrip(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = _ids(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_empty_table_and_clash(spark, codec):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.prepare(df, PATH) is not None
    assert bpe.encode(df, codec).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "a")], "ids long, text string"), codec)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=60))
def test_transducer_is_exact_and_minimal(words):
    entries = [(w, [i, i + 1][: i % 3]) for i, w in enumerate(sorted(words))]
    lex = lexicon.Lexicon(lexicon.build(entries))
    assert len(lex) == len(words)
    for w, ids in entries:
        assert lex.lookup(w) == np.array(ids, "<u4").tobytes()
    for w in (b"", b"zzzzzzz", *[w + b"\x00" for w in words], *[w[:-1] for w in words]):
        assert (lex.lookup(w) is None) == (w not in words)
    # minimal: no two states accept the same set of suffixes
    futures = set()

    def future(s):
        return (lex.final[s], tuple((lex.label[e], future(lex.target[e])) for e in range(lex.edge_start[s], lex.edge_start[s + 1])))

    states = len(lex.final)
    futures = {future(s) for s in range(states)}
    assert len(futures) == states


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab'sé1! \n\t\r\xa0 ", max_size=40))
def test_cutting_at_spaces_equals_the_library(text):
    model = bpe._bpe(PATH)
    memo = bpe._Pieces(bpe._Words(model, lexicon.Lexicon(lexicon.build([]))))
    for _ in range(2):
        assert np.frombuffer(memo.encode(text), "<u4").tolist() == _ids(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abtheing", min_size=40, max_size=200))
def test_both_ways_of_merging_agree(text):
    model = bpe._bpe(PATH)
    ids = [model.byte_id[b] for b in text.encode()]
    assert model._merge_long(ids) == _ids(text)


NBSP = "\xa0"
WHITE_RUNS = [
    f"a {NBSP} {NBSP} b", f"a {NBSP} {NBSP} ", f"a\n {NBSP} {NBSP} b", f" {NBSP} {NBSP}", f"a{f' {NBSP}' * 8} b  c", "a\n \n \n b", "a\t ", "a  b",
    "a   b", "a  ", "  ", f"  a {NBSP}b", f"x <|endoftext|> {NBSP} {NBSP} <|endoftext|>  y", f"it's  {NBSP} ok \u3000 \u3000 !  1   2",
]


def test_mixed_white_space_runs_equal_the_library(spark, codec):
    df = spark.createDataFrame(list(enumerate(WHITE_RUNS)), "doc_id long, text string")
    for r in bpe.decode(bpe.encode(df, codec), codec).collect():
        want = _ids(WHITE_RUNS[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == want, WHITE_RUNS[r.doc_id]
        assert r.n_tokens == len(want) and r.decoded == WHITE_RUNS[r.doc_id]


def test_words_are_counted_as_the_pattern_splits(spark):
    want = Counter(w for t in WHITE_RUNS for w in bpe.splitter().findall(t))
    df = spark.createDataFrame([(t,) for t in WHITE_RUNS], "text string").repartition(2)
    assert {r.word: r.n for r in bpe.word_counts(df).collect()} == want


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="a1! \n\xa0\u3000", max_size=24))
def test_cut_places_are_crossed_by_no_word(text):
    split = bpe.splitter().findall
    first, *rest = bpe.cut(text)
    assert split(first) + [w for piece in rest for w in split(" " + piece)] == split(text)


def test_every_code_point_equals_the_library(tmp_path):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["\n".join(f"!{c}'sa1{c}1 {c}'s" for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.build_lexicon([], bpe._bpe(PATH)))
    got = bpe.Encoder(PATH, str(path), bpe.unicode_classes()).batch(pa.array(texts)).to_pylist()
    for g, want in zip(got, LIB.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == want.ids


LONG_TEXTS = [
    "word and words, " * 20_000, "x" * 300_000, "  tabs\t and   runs " * 5_000, "Ünïcödé — 東京 🙂, it's " * 8_000 + "<|endoftext|>" * 3,
]


def test_long_texts_equal_the_library(spark, codec):
    df = spark.createDataFrame(list(enumerate(LONG_TEXTS)), "doc_id long, text string")
    for r in bpe.encode(df, codec, decoded=True).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == _ids(LONG_TEXTS[r.doc_id])
        assert r.decoded == LONG_TEXTS[r.doc_id]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abtheing ,.é", max_size=40), max_size=30))
def test_rows_of_words_merge_like_single_words(words):
    model = bpe._bpe(PATH)
    for frequent in ([], sorted(set(words))[::2]):
        lex = lexicon.Lexicon(bpe.build_lexicon(frequent, model))
        got = bpe.encode_words(pa.array(words, pa.string()), model, lex).to_pylist()
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [model.merge(w.encode()) for w in words]
        assert [merges.merge_long(model.table, [model.byte_id[b] for b in w.encode()]) for w in words] == [
            model.merge(w.encode()) for w in words]


def test_ill_formed_ids_decode_with_replacement(spark, codec):
    rows = [(0, np.array([162, 254, 64], "<u4").tobytes()), (1, None), (2, b""), (3, np.array([50256], "<u4").tobytes())]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in rows], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, codec).collect()}
    assert got == {i: LIB.decode(np.frombuffer(b or b"", "<u4").tolist(), skip_special_tokens=False) for i, b in rows}
