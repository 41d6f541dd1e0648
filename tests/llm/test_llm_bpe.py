"""Encoding against the reference tokenizer library, the hash against its definition."""

import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyroom.llm import bpe
from tallyroom.llm.catalog import bpe_digests

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_given_texts(spark, own, library):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    for (text,) in rows:
        ids = own.encode(text).tolist()
        assert ids == library.encode_ordinary(text or "")
        assert own.decode(ids) == (text or "").encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    own = bpe.load(PATH, public_tokenizers.PATTERN)
    ids = own.encode(text).tolist()
    assert ids == test_any_text.library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@pytest.fixture(autouse=True, scope="module")
def _library(library):
    test_any_text.library = library


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "\n" * 999, "ab" * 4000, "\U0001f642" * 700, "1" * 2000])
def test_long_pre_tokens(own, library, text):
    assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    ranks = {f"k{i}".encode(): i for i in range(3000)}
    table = bpe.PerfectHash(ranks)
    assert sorted(table.keys) == sorted(ranks)
    assert all(table.get(k) == r for k, r in ranks.items())
    assert all(table.get(f"x{i}".encode()) is None for i in range(3000))
    assert bpe.PerfectHash({}).get(b"a") is None


def test_a_full_cache_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 8)
    monkeypatch.setattr(bpe, "PARTS", 8)
    text = "Some words, other words; unheardofwords thattakemerges and words again. " * 3
    assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_frames(spark, own):
    rows = [(1, "one two", 3), (1, "one two", 3), (2, None, None), (3, "", 0), (None, "x" * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe.encode(docs, own)
    back = bpe.decode(coded, own).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    digests = bpe_digests(docs, own).collect()
    assert len(digests) == len(rows)
    assert {r["n_tokens"] for r in digests if r["doc_id"] in (2, 3)} == {0}
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(none, own).first()["decoded"]) == b""


def test_vocabulary_bound(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY", 2)
    with pytest.raises(ValueError):
        bpe.Tokenizer({b"a": 0, b"b": 1, b"c": 2}, ".")
