"""FM-index, spans and removal against plain search."""

import re

import numpy as np
import pytest

from tallyroom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    phrases = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        n = min(dc.WINDOW, len(words))
        for i in range(len(words) - n + 1 if n and item is not None else 0):
            phrases.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in phrases:
                    hit.update(range(i, i + n))
                    found |= phrases[tuple(words[i : i + n])]
        out.append((doc_id, len(words), sorted(hit), sorted(found)))
    return out


def rows_of(found):
    return [
        (r["doc_id"], r["n_words"], [i for run in r["runs"] for i in range(run["from"], run["to"])], list(r["items"]))
        for r in found.collect()
    ]


@pytest.mark.parametrize("n", [1, 2, 50, 3000])
def test_suffix_array(n):
    rng = np.random.default_rng(n)
    text = np.concatenate([rng.integers(1, 4, n - 1), [0]])
    order = dc.suffix_array(text, 4)
    data = text.tolist()
    assert order.tolist() == sorted(range(n), key=lambda i: data[i:])


def test_wavelet_matrix():
    data = np.random.default_rng(0).integers(0, 11, 500)
    matrix = dc.WaveletMatrix(data, 11)
    at = np.arange(500)
    symbol, rank = matrix.access(at)
    assert (symbol == data).all()
    assert rank.tolist() == [int((data[:i] == data[i]).sum()) for i in at]
    for c in range(11):
        assert matrix.rank(np.full(501, c), np.arange(501)).tolist() == [int((data[:i] == c).sum()) for i in range(501)]


def make():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(6)] + ["Été", "ß9"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(n)) for i, n in enumerate([12, 10, 25, 3, 1, 10])] + [(6, None), (7, " .,! "), (None, "w1 w2"), (8, "lonely")]
    docs = [(i, text(n)) for i, n in enumerate([0, 1, 9, 200, 500])]
    docs += [(10 + i, f"{text(5)}! {items[i][1].upper()}-{text(20)},{items[i][1]}") for i in range(3)]
    docs += [(20, None), (21, ""), (None, items[0][1]), (22, "x " * 3000 + items[1][1]), (22, "x " * 3000 + items[1][1])]
    return docs, items


@pytest.fixture(scope="module")
def frames(spark):
    docs, items = make()
    return (
        spark.createDataFrame([(*d, 3, "r") for d in docs], "doc_id long, text string, n_words int, runs string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize(("window", "shard", "slice_words"), [(10, 1 << 19, 10**6), (4, 64, 10**6), (10, 300, 5)])
def test_spans(frames, monkeypatch, window, shard, slice_words):
    monkeypatch.setattr(dc, "WINDOW", window)
    monkeypatch.setattr(dc, "SHARD_WORDS", shard)
    monkeypatch.setattr(dc, "SLICE_WORDS", slice_words)
    monkeypatch.setattr(dc.Phrases.__init__, "__defaults__", (window,))
    docs, items = make()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(rows_of(dc.find(frames[0].coalesce(1), frames[1])), key=key) == sorted(brute(docs, items), key=key)


def test_removal(spark, frames):
    docs, items = make()
    cleaned = dc.remove(frames[0], frames[1])
    assert cleaned.schema == frames[0].schema
    rows = cleaned.collect()
    assert all(not hit for _, _, hit, _ in brute([(r["doc_id"], r["text"]) for r in rows], items))
    clean = {d for d, _, hit, _ in brute(docs, items) if not hit}
    before = dict(docs)
    assert all(r["text"] == before[r["doc_id"]] for r in rows if r["doc_id"] in clean)
    assert clean <= {r["doc_id"] for r in rows}
    assert None not in {r["doc_id"] for r in rows}  # nothing of it was left


def test_n_chars_follows(spark):
    docs = spark.createDataFrame([(1, "Keep, a b c! keep.", 18), (2, "other", 99)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([(1, "A b C")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in dc.remove(docs, items).collect()}
    assert rows[1]["text"] == "Keep, ! keep." and rows[1]["n_chars"] == 13
    assert rows[2]["n_chars"] == 99


def test_removal_is_the_same_by_slices(spark, frames, monkeypatch):
    w = [f"w{i}" for i in range(1, 13)]
    # Overlapping windows of two items, and phrases that come up when others are cut.
    items = [(i, " ".join(x)) for i, x in enumerate([w[:10], w[2:], ["p", "q"], ["r", "s"], ["t", "u", "v"]])]
    text = "Keep " + " ".join(w) + " p r s q this, t r p q s u v end"
    docs = [(1, text, 1), (2, "p r s q", 2), (3, "clean", 99), (4, None, 4), (5, text, 5)]
    docs += [(10 + i, f"a {x} b {y} c", 0) for i, (x, y) in enumerate((items[j][1], items[k][1]) for j in range(5) for k in range(5))]
    docs = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    items = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: (str(r[0]), r[1:])
    other = sorted(map(tuple, dc.remove(*frames).collect()), key=key)
    whole = sorted(map(tuple, dc.remove(docs, items).collect()))
    assert whole[0] == (1, "Keep   this,  end", 17)
    monkeypatch.setattr(dc, "SLICE_WORDS", 12)
    assert len(dc._slices(items)) > 2
    assert sorted(map(tuple, dc.remove(docs, items).collect())) == whole
    monkeypatch.setattr(dc, "SLICE_WORDS", 40)
    assert sorted(map(tuple, dc.remove(*frames).collect()), key=key) == other
