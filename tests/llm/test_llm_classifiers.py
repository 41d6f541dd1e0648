"""Held-out accuracy of the classifiers, and their defined results."""

import zlib

import numpy as np
import pytest

from tallyroom.llm import catalog, quality, toxicity

LEARN = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    rows = catalog.queries()[name](spark, LEARN).toPandas()
    labels = spark.read.parquet(f"{LEARN}/labels.parquet").select("doc_id", label).toPandas()
    both = rows.merge(labels, on="doc_id")
    return rows, both[both.held_out], label


def auc(rows, label):
    rank = rows.score.rank()
    ones = rows[label] == 1
    n, m = ones.sum(), (~ones).sum()
    return (rank[ones].sum() - n * (n + 1) / 2) / (n * m)


def test_quality_held_out(spark):
    rows, held, label = held_out(spark, "op1_quality", "quality")
    folds = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id])
    assert (rows.held_out == folds).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    assert auc(held, label) > 0.99
    assert held[held[label] == 1].predicted.mean() > 0.98
    assert held[held[label] == 0].predicted.mean() < 0.1


def test_toxicity_held_out(spark):
    rows, held, label = held_out(spark, "op2_toxicity", "toxic")
    folds = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id])
    assert (rows.held_out == folds).all()
    assert (rows.predicted == (rows.score >= 0.7)).all()
    assert auc(held, label) > 0.93
    assert held[held[label] == 1].predicted.mean() > 0.85
    assert held[held[label] == 0].predicted.mean() < 0.03


DOCS = "doc_id long, text string, score double, label int, shard int"
ODD = [
    (1, "a plain good text", 5.0, 1, 1), (1, "a plain good text", 5.0, 1, 1), (2, None, None, None, None),
    (3, "", 0.0, 0, 0), (None, "bad!!! bad!!! bad!!!", 1.0, 1, 1), (4, "bad!!! worse!!! " * 20_000, 1.0, 0, 0),
]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_are_scored_once_each(spark, module):
    docs = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame(
        [(1, 1), (1, None), (4, 0), (None, 0), (9, 1), (2, 0), (3, 1)], "doc_id long, label int"
    )
    model = module.fit(docs, labels)
    rows = module.score(docs, model).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ODD)
    assert all(0 <= r["score"] <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by_id[1]) == 1
    assert by_id[2] == by_id[3]


def test_without_labels(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert toxicity.fit(docs, none) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_filters_keep_all_columns(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    model = np.zeros((1 << quality.BITS) + 1, np.float32)
    assert quality.keep_good(docs, model).schema == docs.schema
    assert quality.keep_good(docs, model).count() == len(ODD)
    model[-1] = -10
    assert quality.keep_good(docs, model).count() == 0
    assert toxicity.keep_clean(docs, None).count() == len(ODD)


def test_ftrl_learns_a_word():
    good, bad = quality.features("fine words here"), quality.features("awful words here")
    w = quality.ftrl([good, bad] * 50, np.array([1.0, 0.0] * 50))
    assert quality.score_text(w, "fine words here") > 0.9 > 0.1 > quality.score_text(w, "awful words here")


def test_nnpu_finds_positives_in_the_unlabelled():
    rng = np.random.default_rng(0)
    words = [f"w{i:03d}" for i in range(200)]

    def text(toxic):
        return " ".join([*rng.choice(words, 30), *(["venom"] if toxic else [])])

    positive = [toxicity.features(text(True)) for _ in range(60)]
    mixed = [toxicity.features(text(i % 10 == 0)) for i in range(600)]
    w = toxicity.fit_nnpu(positive, mixed, 0.1)
    scorer = toxicity.Scorer(w.astype(np.float32))
    assert min(scorer(text(True)) for _ in range(50)) > 0.7
    assert max(scorer(text(False)) for _ in range(50)) < 0.3


@pytest.mark.parametrize("of", [1, 2])
def test_a_hot_id_does_not_break_the_bound(spark, of):
    from tallyroom.llm.common import one_each, sampled

    rows = [(7, "hot")] * 5000 + [(i, f"text {i}") for i in range(100, 100 + 5000 // of)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for _ in range(2):
        kept = one_each(sampled(docs, "doc_id", 500), "doc_id")
        assert kept.count() <= 600 and kept.where("doc_id = 7").count() <= 1


def plain_ftrl(rows, labels):
    """Per-coordinate FTRL over dicts, as its papers write it."""
    import math

    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return (sign * quality.L1 - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    order = np.random.default_rng(0)
    for _ in range(quality.EPOCHS):
        for at in order.permutation(len(rows)):
            y, ids = labels[at], [*rows[at][0].tolist(), 1 << quality.BITS]
            x = [*rows[at][1].tolist(), 1.0]
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(weight(i) * v for i, v in zip(ids, x))))))
            for i, v in zip(ids, x):
                g, w = (p - y) * v, weight(i)
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA
                z[i] = z.get(i, 0.0) + g - s * w
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_ftrl_is_the_plain_one():
    texts = ["good text here", "bad bad bad", "good good words", "", "bad text", "here are words", "one bad word"]
    labels = np.array([1.0, 0, 1, 0, 0, 1, 0])
    rows = [quality.features(t) for t in texts]
    made = quality.ftrl(rows, labels)
    expected = plain_ftrl(rows, labels)
    assert set(np.flatnonzero(made)) == {i for i, w in expected.items() if w}
    assert all(abs(made[i] - w) < 1e-9 for i, w in expected.items())
    for text in texts:  # a score is the sigmoid of the plain sum
        ids, x = quality.features(text)
        total = sum(expected.get(i, 0.0) * v for i, v in zip(ids.tolist(), x)) + expected[1 << quality.BITS]
        assert abs(quality.score_text(made, text) - 1 / (1 + np.exp(-total))) < 1e-9


def plain_nnpu(toxic, unlabelled, prior):
    """The same descent on whole matrices, one column a feature."""
    size = 1 << toxicity.BITS
    used = sorted({i for r in [*toxic, *unlabelled] for i in r.tolist()})
    x = np.array([[i in set(r.tolist()) for i in used] for r in [*toxic, *unlabelled]], float)
    n_p, n_u = len(toxic), len(unlabelled)
    df_p, df_u = x[:n_p].sum(axis=0), x[n_p:].sum(axis=0)
    in_p, in_u, both = (df_p + 0.5) / (n_p + 1), (df_u + 0.5) / (n_u + 1), (df_p + df_u + 1) / (n_p + n_u + 2)
    surplus = (in_p - in_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    kept = (surplus >= toxicity.SELECT) & (df_p >= 2)
    share = np.minimum((df_p + df_u + 1)[kept] / (n_p + n_u), 1)
    scale = 1 / np.sqrt(share * (1 - share) + 1e-3)
    z = (x[:, kept] - share) * scale
    w, b = np.zeros(z.shape[1]), 0.0

    def risk(w, b):
        f = z @ w + b
        rest = np.mean(np.log1p(np.exp(f[n_p:]))) - prior * np.mean(np.log1p(np.exp(f[:n_p])))
        return prior * np.mean(np.log1p(np.exp(-f[:n_p]))), rest

    def gradient(w, b):
        """Of the risk, or of minus its negative part where that is the one to mend; by differences."""
        value = (lambda w, b: sum(risk(w, b))) if risk(w, b)[1] >= 0 else (lambda w, b: -risk(w, b)[1])
        h = 1e-6
        g = [(value(w + h * e, b) - value(w - h * e, b)) / (2 * h) for e in np.eye(len(w))]
        return np.array(g), (value(w, b + h) - value(w, b - h)) / (2 * h)

    for _ in range(toxicity.ITERATIONS):
        g, gb = gradient(w, b)
        w = w - toxicity.RATE * (g + toxicity.L2 * w)
        w = np.sign(w) * np.maximum(np.abs(w) - toxicity.RATE * toxicity.L1, 0)
        b -= toxicity.RATE * gb
    out = np.zeros(size + 1)
    out[np.array(used)[kept]] = w * scale
    out[-1] = b - float(w @ (share * scale))
    return out


def test_nnpu_is_the_plain_descent():
    rng = np.random.default_rng(5)
    toxic = [np.unique(rng.choice([3, 5, 8, 13], 3)) for _ in range(40)]
    unlabelled = [np.unique(rng.choice(60, 6)) for _ in range(160)]
    made = toxicity.fit_nnpu(toxic, unlabelled, 0.1)
    expected = plain_nnpu(toxic, unlabelled, 0.1)
    assert np.count_nonzero(made[:-1]) > 0
    assert np.allclose(made, expected, atol=1e-4)
