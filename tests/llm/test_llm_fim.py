"""Fill-in-middle: the rank index against plain counting, the transformation against plain slicing."""

import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as quick
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyroom.llm import fim


def plain(doc_id, text, fmt=fim.Format()):
    """The row by slicing the text itself."""
    text = text or ""
    digest = hashlib.sha256(f"{fmt.seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    marks = (fmt.prefix, fmt.suffix, fmt.middle)
    if not text or any(m in text for m in marks) or h[2] % 100 >= fmt.transformed:
        return doc_id, n, "plain", None, None, text, text
    p, s, m = (x + y for x, y in zip(marks, (text[:a], text[b:], text[a:b])))
    spm = h[3] % 100 < fmt.spm
    return doc_id, n, "spm" if spm else "psm", a, b - a, s + p + m if spm else p + s + m, text


@quick(max_examples=80, deadline=None)
@given(st.text(alphabet="aé€😀", max_size=600), st.sampled_from([1, 2, 100]), st.sampled_from([7, 64, 1 << 20]))
def test_index_knows_every_boundary(text, error, window):
    data = text.encode()
    index = fim.RankIndex(np.frombuffer(data, np.uint8), error, window)
    expected = [len(text[:i].encode()) for i in range(len(text) + 1)]
    assert index.offsets(np.arange(len(text) + 1)).tolist() == expected
    assert index.ranks(np.array(expected)).tolist() == list(range(len(text) + 1))


def test_segments_are_few_where_texts_are_even():
    plain_bytes = np.frombuffer(b"a" * 100_000, np.uint8)
    assert len(fim.RankIndex(plain_bytes).first) == 1
    accents = np.frombuffer(("é" * 50_000 + "a" * 50_000).encode(), np.uint8)
    assert len(fim.RankIndex(accents).first) == 2


def test_rows(spark):
    texts = [
        None, "", "a", "éàü", "x<P>y", "<S", "<", "<M>", "😀" * 999, "<P" * 50, "S>" * 50, "word " * 60_000,
        "áe\n\r\n\x00z",
    ]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(None, "no id"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Other columns, with names of the result's own.
    docs = docs.withColumns({"n": F.lit("x"), "form": F.lit(1), "H1": F.lit(2), "output": F.lit(3.0)})
    made = fim.transform(docs).select("*", fim.restored().alias("restored")).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, made), key=key) == sorted((plain(*r) for r in rows), key=key)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_other_sentinels(spark):
    fmt = fim.Format("[pre]", "[suf]", "[mid]", "7:", 100, 50)
    rows = [(i, f"text [pre {i} ]suf] <P>é") for i in range(60)]
    made = fim.transform(spark.createDataFrame(rows, "doc_id long, text string"), fmt)
    made = made.select("*", fim.restored(fmt).alias("restored")).collect()
    assert sorted(map(tuple, made)) == sorted(plain(*r, fmt) for r in rows)


@pytest.mark.parametrize("marks", [("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("abc", "b", "x")])
def test_sentinels_that_could_be_misread(marks):
    with pytest.raises(ValueError):
        fim.Format(*marks)
