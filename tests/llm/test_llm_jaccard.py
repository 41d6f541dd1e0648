"""Classes by brute force over all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import jaccard
from tallyroom.llm.common import Workspace
from tallyroom.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Smallest id of each row's class; rows that repeat an id are one document."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            same = rows[a][0] is not None and rows[a][0] == rows[b][0] and x and y
            if same or (x and y and 100 * len(x & y) >= 75 * len(x | y)):
                parent[find(a)] = find(b)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        if not sets[i]:
            out.append((doc_id, 0, doc_id))
            continue
        ids = [rows[j][0] for j in range(len(rows)) if sets[j] and find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return out


def make(seed):
    """Sizes of 1 to 400 shingles, chains of near copies, a common passage, copies."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choice(words, 40).tolist()
    texts = []
    for size in [1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 18, 24, 30, 60, 120, 400] * 2:
        base = rng.choice(words, size).tolist()
        texts.append(base)
        for _ in range(rng.integers(1, 6)):
            copy = list(texts[-1] if rng.random() < 0.5 else base)
            for _ in range(rng.integers(1, 4)):
                at = int(rng.integers(0, len(copy)))
                kind = rng.integers(0, 4)
                if kind == 0:
                    copy[at] = str(rng.choice(words))
                elif kind == 1:
                    copy = copy[:at] + copy[at + 1 :] or copy
                elif kind == 2:
                    copy.append(str(rng.choice(words)))
                else:
                    copy = [str(rng.choice(words)), *copy]
            texts.append(copy)
    for _ in range(60):
        own = rng.choice(words, int(rng.integers(5, 60))).tolist()
        texts.append([*own, *passage])
    hub = rng.choice(words, 100).tolist()
    for _ in range(80):
        copy = list(hub)
        for _ in range(int(rng.integers(1, 6))):
            copy[int(rng.integers(0, 100))] = str(rng.choice(words))
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(0, 40, 3)]
    return [rows[i] for i in rng.permutation(len(rows))]


ODD = [(500, None), (501, ""), (501, " \t "), (None, None), (2001, "same again"), (2001, "same again"), (2001, "other words now")]


@pytest.mark.parametrize(("seed", "block", "bucket", "partitions"), [(1, 512, 32, 3), (2, 16, 8, 7), (3, 8, 2, 1)])
def test_classes(spark, monkeypatch, seed, block, bucket, partitions):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    rows = make(seed) + ODD + [(None, make(seed)[0][1]), (None, "alone without an id"), (3000, "Other words NOW")]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, id int, node string")
    with Workspace(spark, "test-jaccard") as space:
        found = [tuple(r) for r in jaccard.classes(docs.repartition(partitions), space).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def test_representatives(spark):
    rows = make(4) + ODD
    docs = spark.createDataFrame([(*r, i, "n") for i, r in enumerate(rows)], "doc_id long, text string, id int, node string")
    with Workspace(spark, "test-jaccard") as space:
        kept = jaccard.representatives(docs, space)
        assert kept.schema == docs.schema
        kept = kept.collect()
    labels = brute(rows)
    classes = {label for (_, n, label) in labels if n}
    worded = [r for r in kept if shingles(r["text"])]
    assert sorted(r["doc_id"] for r in worded) == sorted(classes)
    assert len(kept) - len(worded) == sum(not shingles(t) for _, t in rows)


def test_signatures_hold_the_promise():
    """Every pair that links shares as many signatures as both sets promise."""
    words = jaccard._Words()
    sets = [jaccard.shingles(t, words) for _, t in make(9)]
    sets = [s for s in sets if len(s)]
    none = np.empty(0, np.uint64)
    every = np.unique(np.concatenate([np.concatenate(jaccard._segments(s)) for s in sets if len(s) > 5]))
    for heavy in (none, every[::3]):
        listed = [jaccard.signatures(s, heavy) for s in sets]
        least = [jaccard.promise(len(s), jaccard._segments(s) if len(s) > 5 else []) for s in sets]
        for a in range(len(sets)):
            for b in range(a):
                overlap = len(np.intersect1d(sets[a], sets[b]))
                if 100 * overlap >= 75 * (len(sets[a]) + len(sets[b]) - overlap):
                    shared = len(np.intersect1d(listed[a], listed[b]))
                    assert shared >= min(least[a], least[b])


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, 9), (9, 5), (7, 7), (200, 9), (300, 301), (301, 302), (300, 302)]
    with Workspace(spark, "test-components") as space:
        found = {tuple(r) for r in components(spark.createDataFrame(links, "u long, v long"), space).collect()}
    assert found == {(i, 100) for i in range(101, 141)} | {(9, 5), (200, 5), (301, 300), (302, 300)}


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_shared_rows(step):
    """Rows that stay, whatever the batches: those that meet a set of a size they can link with."""
    rng = np.random.default_rng(step)
    rows = sorted({(int(s), int(n), int(k)) for s, n, k in rng.integers(1, [25, 60, 3], (400, 3))})
    rows += [(30, 10 + i % 40, 100 + i) for i in range(60)]  # a large signature
    rows = sorted((s, n, 1000 * n + k) for s, n, k in rows)

    def batches():
        for at in range(0, len(rows), step):
            sig, n, node = zip(*rows[at : at + step])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig, pa.int64()), pa.array(node, pa.int64()), pa.array(n, pa.int32())],
                names=["sig", "node", "n"],
            )

    got = {tuple(r.values()) for b in jaccard._shared_rows(batches()) for r in b.to_pylist()}
    of: dict[int, set] = {}
    for sig, n, node in rows:
        of.setdefault(sig, set()).add((n, node))
    wanted = {
        (sig, node, n, len(sets) > jaccard.BUCKET)
        for sig, sets in of.items()
        for n, node in sets
        if len(sets) > jaccard.BUCKET
        or any(4 * min(n, m) >= 3 * max(n, m) for m, other in sets if other != node)
    }
    assert got == wanted
    assert any(large for *_, large in got) and len(got) < len(rows)


def test_texts_of_no_group_are_left_out_where_they_are(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 - 9000).alias("id"), F.lit("some text").alias("text"))
    wanted = [i * 7919 - 9000 for i in range(0, 20_000, 100)]
    with Workspace(spark, "test-marks") as space:
        kept = jaccard._marked(rows, spark.createDataFrame([(i,) for i in wanted], "id long"), space)
        assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
        found = {r.id for r in kept.collect()}
    assert found >= set(wanted) and len(found) < 4_000


def test_sets_are_dealt_once(spark):
    """What is known of a set and its numbers of signatures come from one shuffle of the signatures."""
    ddl = "sig long, node long, n int, large boolean"
    shared = spark.createDataFrame([(s, n, 40, s % 5 == 0) for s in range(40) for n in (1, 2, s + 9)], ddl)
    owners = spark.createDataFrame([(n, n, 4, 4) for n in range(50)], "node long, rep long, shared long, partners int")
    stored = []

    class Watched(Workspace):
        def step(self, df):
            stored.append(df._jdf.queryExecution().executedPlan().toString())
            return super().step(df)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Watched(spark, "test-dealt") as space:
            links = jaccard._candidates(shared, owners, space).collect()
            assert {(min(r), max(r)) for r in links} == {(1, 2)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert stored[0].count("Exchange hashpartitioning(node") == 2  # signatures and owners


def test_words_are_hashed_side_by_side():
    """As many different hashes as different words, whatever the texts' edges; only long words are asked for singly."""
    asked = []

    class Asked(jaccard._Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    long = "x" * jaccard._SHORT
    texts = [
        "left out", "ab", "cd ab", None, "", " \t\n\x0b\x0c\r ", "AB ab\x00 abcdefgh abcdefghi ABCDEFGHIJKLMNOPQ", "É é ab cd 漢字",
        long, f" {long}y {long}z {long}Y ", " ".join(f"w{i}" for i in range(3000)), "cd",
    ]
    wanted = [(t or "").encode().lower().split() for t in texts[1:]]
    for kind in (pa.string(), pa.large_string()):
        h, edge = jaccard.word_hashes(pa.array(texts, kind).slice(1), Asked())
        assert np.diff(edge).tolist() == [len(w) for w in wanted]
        hashes: dict[bytes, set] = {}
        for word, value in zip((w for text in wanted for w in text), h.tolist()):
            hashes.setdefault(word, set()).add(value)
        assert all(len(values) == 1 for values in hashes.values())
        assert len(set(h.tolist())) == len(hashes)
    assert {len(w) for w in asked} == {jaccard._SHORT + 1}
    h, edge = jaccard.word_hashes(pa.array([], pa.string()), Asked())
    assert not len(h) and edge.tolist() == [0]
    assert [len(s) for s in jaccard.shingle_sets(pa.array(["", None]), Asked())] == [0, 0]


def test_sets_of_texts_side_by_side():
    """Sets overlap as those of word sequences do: nothing runs from one text into the next."""
    texts = [t for _, t in make(4)] + ["a b c d e", "a b c d", "e a b c d e", "a b c d e a b c d e", None, "A  b c\nd"]
    sets = jaccard.shingle_sets(pa.array(texts, pa.string()), jaccard._Words())
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_shared_rows_of_one_signature_in_any_order(step):
    """Rows come sorted by signature alone."""
    rng = np.random.default_rng(step)
    rows = [(s, 10 + n, 1000 * s + n) for s in range(40) for n in range(0, 30, 1 + s % 9)]
    rows += [(40, 100 + i, i) for i in range(90)] + rows[::3]
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[0])

    def batches():
        for at in range(0, len(rows), step):
            sig, n, node = (np.array(c) for c in zip(*rows[at : at + step]))
            columns = [pa.array(sig, pa.int64()), pa.array(node, pa.int64()), pa.array(n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["sig", "node", "n"])

    got = {tuple(r.values()) for b in jaccard._shared_rows(batches()) for r in b.to_pylist()}
    of: dict[int, set] = {}
    for sig, n, node in rows:
        of.setdefault(int(sig), set()).add((int(n), int(node)))
    assert got == {
        (sig, node, n, len(sets) > jaccard.BUCKET)
        for sig, sets in of.items()
        for n, node in sets
        if len(sets) > jaccard.BUCKET or any(4 * min(n, m) >= 3 * max(n, m) for m, other in sets if other != node)
    }
