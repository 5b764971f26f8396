"""Token files and byte-level BPE against the tokenizer libraries."""

import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tests.llm.helpers import SF, collected, rows, same
from tickroll.llm import bpe, token_files
from tickroll.llm.catalog import QUERIES
from tickroll.llm.chunks import CUT

TEXTS = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a \n b", "it's  'tis\n\n\tx", "<|endoftext|> a <|endoftext|>", "  x y \x1c z",
         "日本語 テスト 🎉🎉", "x" * 5000, " " * 3000, "é" * 400, "12 345 6789", "a\x85 b", "word\r\n  word", "\x00 \x01"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextBpe(bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)


def test_token_file_query(spark):
    same(QUERIES["op5_token_files"](spark, SF), ["doc_id", "start", "n_tokens", "ids_crc32"],
         brute.token_files(rows("documents", "doc_id", "text")))


def test_token_file_edge_cases(spark):
    docs = list(enumerate(TEXTS, 10))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, shard int, n_tokens string")
    path = token_files.write_tokens(df, P.path("byte_bpe_50k.json"), end_id=0)
    got = token_files.read_tokens(spark, path)
    from pyspark.sql import functions as F
    same(got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")), ["doc_id", "start", "n_tokens", "c"],
         brute.token_files(docs))
    one = token_files.read_tokens(spark, path, doc_id=20).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in one] == [(20, brute.token_files([docs[10]])[0][2])]


def test_token_files_of_repeated_and_missing_ids(spark):
    docs = [(None, "b"), (None, "a a"), *[(7, f"t{i}") for i in range(40)], (7, "t1"), (9, "end")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    path = token_files.write_tokens(df, P.path("byte_bpe_50k.json"), end_id=0)
    got = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in token_files.read_tokens(spark, path).collect())
    assert [g[2] for g in got] == [None] * 2 + [7] * 41 + [9]
    assert all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:])) and got[0][0] == 0


def test_token_files_of_an_empty_table(spark):
    path = token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), P.path("byte_bpe_50k.json"), end_id=0)
    assert collected(token_files.read_tokens(spark, path)) == []


def test_bpe_query(spark):
    same(QUERIES["op6_bpe"](spark, SF), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
         brute.bpe(rows("documents", "doc_id", "text")))


def test_bpe_edge_cases(spark, encoder):
    docs = [(None if i == 3 else i, t, 1) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string, ids int")
    coded = bpe.encode_texts(df, encoder.bpe.ranks, P.PATTERN)
    want = brute.rank_encoder()
    assert collected(coded, "doc_id", "ids") == sorted(((i, want.encode_ordinary(t or "")) for i, t, _ in docs), key=repr)
    back = bpe.decode_ids(coded, encoder.bpe.ranks)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((t or "").encode() for _, t, _ in docs)
    assert bpe.encode_texts(df.limit(0), encoder.bpe.ranks, P.PATTERN).collect() == []


ALPHABET = st.text(alphabet="abest 's\n.é日1 ", max_size=40)


@settings(max_examples=200, deadline=None)
@given(ALPHABET, ALPHABET)
def test_cuts_do_not_change_the_ids(a, b):
    encoder = _encoder()
    text = a + " " + b
    want = encoder.encode(text)
    head, *rest = CUT.split(text)
    assert [i for part in [head, *[" " + r for r in rest]] for i in encoder.encode(part)] == want
    assert brute_encoder().encode_ordinary(text) == want


@settings(max_examples=150, deadline=None)
@given(ALPHABET, ALPHABET, st.integers(0, 40), st.integers(0, 40), ALPHABET)
def test_appends_and_edits_equal_a_fresh_encoding(text, more, i, j, new):
    encoder = _encoder()
    open_text = bpe.OpenText(encoder, text)
    open_text.append(more)
    whole = text + more
    assert open_text.ids() == encoder.encode(whole)
    start, stop = sorted((min(i, len(whole)), min(j, len(whole))))
    open_text.edit(start, stop, new)
    assert open_text.text == whole[:start] + new + whole[stop:]
    assert open_text.ids() == encoder.encode(open_text.text)


def test_edits_inside_a_long_piece(encoder):
    rnd = random.Random(2)
    old = bytes(rnd.choice(b"abcdefgh") for _ in range(3000))
    last = encoder.bpe.extend(old, [-1])
    data, now = encoder.bpe.edited(old, last, 1500, 1503, b"zz")
    assert encoder.bpe.walk(now) == encoder.bpe.walk(encoder.bpe.extend(data, [-1])) == encoder.bpe.merged(data)


_CACHE = {}


def _encoder():
    if "own" not in _CACHE:
        _CACHE["own"] = bpe.TextBpe(bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    return _CACHE["own"]


def brute_encoder():
    if "lib" not in _CACHE:
        _CACHE["lib"] = brute.rank_encoder()
    return _CACHE["lib"]
