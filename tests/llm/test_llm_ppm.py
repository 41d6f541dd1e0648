"""Prediction by partial matching against a plain coder over dicts, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tallyroom.llm import ppm
from tallyroom.llm.common import fold, table


def contexts_of(texts, order):
    """Counts of each byte after each context of up to ``order`` bytes."""
    seen = defaultdict(Counter)
    for text in texts:
        data = b"\n" * order + text.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[data[i - k : i]][data[i]] += 1
    return seen


def code_length(seen, text, order):
    """Bits of a text, byte by byte, context by context, with exclusion."""
    total, data = 0.0, b"\n" * order + text.encode()
    for i in range(order, len(data)):
        excluded = set()
        for k in range(order, -1, -1):
            known = {b: c for b, c in seen.get(data[i - k : i], {}).items() if b not in excluded}
            if not known:
                continue
            whole = sum(known.values()) + len(known)
            if data[i] in known:
                total -= math.log2(known[data[i]] / whole)
                break
            total -= math.log2(len(known) / whole)
            excluded |= set(known)
        else:
            total += math.log2(256 - len(excluded))
    return total


@pytest.mark.parametrize("order", [1, 2, 4])
@pytest.mark.parametrize("chunk", [5, 1 << 21])
def test_code_lengths(order, chunk, monkeypatch):
    monkeypatch.setattr(ppm, "_CHUNK", chunk)
    rng = random.Random(order)
    learned = [
        ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(20)]
        for letters in ("abcab ", "bcdé\n", "z")
    ]
    trees = []
    for texts in learned:
        data, begin, end = ppm._padded(texts, order)
        grams = np.concatenate([ppm._strings(data, order)[a:b] for a, b in zip(begin, end)])
        trees.append(ppm.Tree(*np.unique(grams, return_counts=True), order))
    asked = ["", "a", "abc", "€", "zzzz", "abcabcabcab", "dédé b\nq", "".join(rng.choices("abcdz", k=200))]
    made = ppm.bits(ppm.Coder(trees, 16), asked, order) / ppm.UNIT
    for j, texts in enumerate(learned):
        seen = contexts_of(texts, order)
        expected = [code_length(seen, t, order) for t in asked]
        assert np.allclose(made[:, j], expected, atol=0.01), j


def test_probabilities_sum_to_one():
    data, begin, end = ppm._padded(["abracadabra"], 2)
    tree = ppm.Tree(*np.unique(ppm._strings(data, 2)[begin[0] : end[0]], return_counts=True), 2)
    for before in (b"ab", b"ra", b"xa", b"xy"):
        base = (before[0] << 16) + (before[1] << 8)
        lengths = tree.lengths(np.array([base + b for b in range(256)], np.uint64))
        assert math.isclose(np.exp2(-lengths / ppm.UNIT).sum(), 1, abs_tol=1e-3)


def test_predictions_are_those_of_the_plain_coder(spark):
    docs = table(spark, SF_DIR, "documents").where("length(text) < 900")
    model = ppm.fit(docs.where(fold("doc_id", 4) != 2))
    rows = {r["doc_id"]: r for r in docs.collect()}
    learns = {r["doc_id"] for r in docs.where(fold("doc_id", 4) != 2).collect()}
    seen = {
        g: contexts_of([r["text"] for i, r in rows.items() if i in learns and r["lang"] == g], ppm.ORDER)
        for g in model.languages
    }
    for r in ppm.predict(docs, model).collect():
        text = rows[r["doc_id"]]["text"]
        bits = {g: code_length(s, text, ppm.ORDER) for g, s in seen.items()}
        if r["lang_pred"] != ppm.UNKNOWN:
            assert r["lang_pred"] == min(bits, key=bits.get)
            assert math.isclose(r["bits"], min(bits.values()), rel_tol=1e-4)
        else:
            assert not any(c.isalpha() for c in text)


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    model = ppm.fit(docs.where(fold("doc_id", 4) != 2))
    held = docs.where(fold("doc_id", 4) == 2)
    lang = {r["doc_id"]: r["lang"] for r in held.collect()}
    made = ppm.predict(held, model).collect()
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in made) >= 0.95 * len(made)


def test_odd_rows(spark):
    learn = [("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "x"), ("fr", None), ("es", "")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(learn)], "doc_id long, lang string, text string")
    model = ppm.fit(docs)
    assert model.languages == ["de", "en"]  # a text of no bytes teaches nothing
    rows = [(None, None), (1, ""), (2, "123 !"), (3, "the dog"), (3, "the dog"), (4, "die katze " * 90_000), (5, "ж")]
    asked = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang_pred": F.lit("x"), "SCORE": F.lit(1), "bits": F.lit("y"), "lang": F.lit("de")}
    )
    made = ppm.predict(asked, model).collect()
    assert len(made) == len(rows) and all(0 <= r["score"] <= 1 for r in made)
    langs = {r["doc_id"]: r["lang_pred"] for r in made}
    assert langs.pop(5) in model.languages  # bytes never seen
    assert langs == {None: "und", 1: "und", 2: "und", 3: "en", 4: "de"}
    none = ppm.fit(docs.limit(0))
    assert {r["lang_pred"] for r in ppm.predict(asked, none).collect()} == {"und"}


def test_the_sample_is_bounded_whatever_repeats(spark):
    rows = [(7, "en", "the same row")] * 300 + [(i, "en", f"row {i}") for i in range(300)] + [(None, "de", "ein")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    one = sorted(map(tuple, ppm.sample(docs, 50).collect()))
    two = sorted(map(tuple, ppm.sample(docs.repartition(7), 50).collect()))
    assert one == two and [g for g, _ in one].count("en") <= 50 and ("de", "ein") in one
