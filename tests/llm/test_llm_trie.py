"""The prefix trie against one over dicts, with shards of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyroom.llm import trie
from tallyroom.llm.common import Workspace

DDL = "conv_id long, turn long, role string, text string"
SHAPE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            code = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv_id].append((turn is not None, turn or 0, code, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        source = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        path = tuple(source[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)

    def below(k):
        stack, found = [k], []
        while stack:
            found.append(stack.pop())
            stack += kids[found[-1]]
        return found

    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in m if end))
        out.append((
            min(m)[0], len(k), min(members[k[:-1]])[0] if k else None, len(m), len(kids[k]),
            sum(not kids[x] for x in below(k)),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below(k) if x),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(spark, rows, shard_rows=trie.SHARD_ROWS, piece_ids=trie.PIECE_IDS, **clash):
    df = spark.createDataFrame(rows, DDL).withColumns(clash).repartition(5)
    with Workspace(spark, "trie-test") as space:
        found = space.keep(trie.nodes(trie.rebuilt(space.step(trie.sequences(df))), space, shard_rows, piece_ids))
    assert tuple(found.columns) == SHAPE
    return sorted(map(tuple, found.collect()), key=str)


def conversations(seed, n=150, words=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-120, 900), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice("aé€"[:words]) * rng.randint(1, 2)))
    return rows


@pytest.mark.parametrize("shard_rows", [1, 2, 7, 20_000])
def test_nodes_whatever_the_shards(spark, shard_rows):
    rows = conversations(shard_rows)
    assert made(spark, rows, shard_rows) == brute(rows)


@pytest.mark.parametrize("piece_ids", [1, 4, 1000])
def test_copies_in_pieces(spark, piece_ids):
    rows = [(c, t, "user", "same") for c in range(400) for t in range(3)] + [(500, 0, "user", "other")]
    assert made(spark, rows, 1, piece_ids) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody's"), (0, None, None, None), (0, 1, "user", None), (0, 1, "user", None), (0, 2, "", ""),
        (1, 5, "a", "b"), (1, 5, "", "ab"), (1, 5, "a", "c"), (1, None, "x", "y"), (7, 0, "user", "long " * 40_000),
        (-5, 0, "user", "below zero"), (-105, 3, "u", "v"), (-100, 0, "u", "w"), (2, 0, "user", "one"), (2, 0, "user", "one"),
    ] + [(300, t, "user", str(t % 3)) for t in range(2500)] + [(301, t, "user", str(t % 3)) for t in range(2400)]
    expected = [r for r in brute([r for r in rows if r[0] not in (300, 301)])]
    assert made(spark, [r for r in rows if r[0] not in (300, 301)], 2, key=F.lit(1), PATH=F.lit("x"), n=F.lit(2)) == expected
    deep = made(spark, rows, 1)
    assert max(r[1] for r in deep) == 2500 and [r[3] for r in deep if r[1] == 0] == [9]
    assert made(spark, [r for r in rows if r[0] is None]) == []


def test_tree_is_balanced_and_whole():
    keys = sorted({tuple(random.Random(i).choices(range(40), k=4)) for i in range(3000)} | {()})
    tree = trie.TernaryTree([list(k) for k in keys])
    listed = dict(tree.listed())
    for end, key in zip(tree.ends, keys):
        walked = []
        while end >= 0:
            walked.append(tree.number[end])
            end = listed[end]
        assert tuple(reversed(walked)) == key
    numbers, depth, at = len({k[0] for k in keys if k}), 0, [tree.root]
    while at:
        depth += 1
        at = [c for n in at for c in (tree.lo[n], tree.hi[n]) if c >= 0]
    assert depth <= 2 * numbers.bit_length()
