"""BPE encoding and decoding against the tokenizers library."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideledger.llm import bpe_codec
from tideledger.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", " \n\t ", "a  b", "It's WE'LL 'S", "<|endoftext|>", "a <|startoftext|>b<|endoftext|><|endoftext|", "a\0b c",
    "\U0001f600 你好，世界。", "1234 56,78!! ?", "É é ΣΑΣ ς İ ǅ ½ ²", "x\x1cy\x85z\xa0w", "x" * 50_000, "ab " * 30_000, "漢字" * 20_000,
    "'" * 5000, "ẹ́ ö",
]
SCHEMA = "doc_id long, text string, ids int, n_tokens int, length int"


@pytest.fixture(scope="module", params=[WORDS, BYTES])
def pair(request):
    with open(request.param, encoding="utf-8") as file:
        return bpe_codec.codec(file.read()), Tokenizer.from_file(request.param)


def same(pair, text):
    coder, library = pair
    ids = library.encode(text, add_special_tokens=False).ids
    assert coder.encode(text).tolist() == ids
    assert coder.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_odd_texts(pair):
    for text in ODD:
        same(pair, text or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinrstlo 'SdD.!1é你Σ́\n<|>"), max_size=60))
def test_random_texts(pair, text):
    same(pair, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", max_size=200), st.text(alphabet="theinran", max_size=40))
def test_random_words(pair, first, second):
    same(pair, first)
    same(pair, second)


def test_code_points():
    with open(WORDS, encoding="utf-8") as file:
        coder = bpe_codec.codec(file.read())
    library = Tokenizer.from_file(WORDS)
    plain = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and not bpe_codec._OTHER.search(c)]
    assert len(plain) > 30_000
    for low in range(0, len(plain), 50):
        text = "".join(f"a{c}b {c} A{c}1{c}! " for c in plain[low : low + 50])
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_caches(pair, monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHED", 3)
    monkeypatch.setattr(bpe_codec, "PAIRS", 3)
    monkeypatch.setattr(bpe_codec, "TOKENS_AT_ONCE", 2)
    pair[0].known.clear()
    pair[0].merges.known.clear()
    for text in ("the cat, the hat; the cats' mats", "one two three four five one two"):
        same(pair, text)


def plain_rows(rows, path):
    library = Tokenizer.from_file(path)
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        body = library.decode(ids, skip_special_tokens=False)
        shown = " ".join(map(str, ids))
        yield doc, ids, body, (doc, len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(body.encode()).hexdigest())


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_tables(spark, path):
    rows = list(enumerate(ODD)) + [(None, "a null id"), (None, None), (3, "a repeated id"), (4, ODD[4])]
    table = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA)
    expected = list(plain_rows(rows, path))
    order = lambda row: (row[0] is None, row[0] or 0, repr(row))
    coded = bpe_codec.encoded(table, path)
    assert sorted([(r.doc_id, r.ids) for r in coded.collect()], key=order) == sorted([(d, i) for d, i, _, _ in expected], key=order)
    bodies = bpe_codec.decoded(coded.selectExpr("*", "1 AS text"), path).collect()
    assert sorted([tuple(r) for r in bodies], key=order) == sorted([(d, b) for d, _, b, _ in expected], key=order)
    found = [tuple(row) for row in bpe_codec.round_trips(table, path).collect()]
    assert sorted(found, key=order) == sorted([digest for *_, digest in expected], key=order)
    nothing = spark.createDataFrame([], SCHEMA)
    assert bpe_codec.round_trips(nothing, path).collect() == [] == bpe_codec.encoded(nothing, path).collect()
    lists = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, bpe_codec.decoded(lists, path).collect())) == [(1, None), (2, "")]


def test_query(spark):
    rows = duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    found = QUERIES["op11_bpe_codec"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found)) == sorted(digest for *_, digest in plain_rows(rows, WORDS))


def test_refused_files():
    with pytest.raises(ValueError):
        bpe_codec.Merges({"type": "BPE", "byte_fallback": True, "vocab": {}, "merges": []})
    with pytest.raises(ValueError):
        bpe_codec.Merges({"type": "BPE", "vocab": {"a": 0}, "merges": []})
