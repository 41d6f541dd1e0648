"""Prefix trie of conversations from ternary search trees over range shards.

A conversation is a sequence of turns; a turn is coded by 128 bits of the SHA-256 of its
role and text, and its text's code points.  Equal sequences are counted first, in ranges
of (sequence, id), so however many conversations say the same, they are spread over tasks
and leave one row a range with their ids written out; those rows are joined by sequence
to one with a digest over all ids.

The distinct sequences are cut into range shards of about ``SHARD_ROWS``.  A shard codes
its turns by a dictionary of its own, numbers in the order of the codes, and inserts its
sequences into a ternary search tree, always the median of a stretch before its halves,
which keeps the tree balanced.  One traversal without recursion lists the trie's nodes,
and going back over the list adds up members, leaves and savings.

Shards share nodes only along their borders: the prefixes of a shard's first sequence
that the shard before has as well.  Every shard knows the last sequence before it and the
first one after it.  Of a node on a border it sends what its own sequences add; the first
shard that has the node counts what is to be counted once (the node itself as a child, as
a leaf, and the one member that pays for its text).  So sums by node merge the borders.

A node's key is a chain of digests over its turns, so rows do not carry whole sequences.

Defined results: conversations are rebuilt from rows ordered by turn, NULL first, then by
the turn's code (equal turns of one number are all kept); a NULL role or text is empty;
rows without a conv_id belong to no conversation; without conversations there is no node,
not even the root; other columns of any name are not read.  The turn codes of one
conversation (40 bytes a turn) are in one task, and a node's ids are written and digested
in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace, map_parts

#: Distinct sequences, and characters of their codes, that a shard has, about.
SHARD_ROWS = 20_000
SHARD_CHARS = 32 << 20
#: Ids that one row has written out.
PIECE_IDS = 50_000
#: Characters of a turn's code: a digest and the number of code points.
DIGEST, CODE = 32, 40
#: The first turns that a conversation can have from another one.
_HEAD = 5


def turn_code(role: Column, text: Column) -> Column:
    """Digest of role and text, then the text's code points, all in hexadecimal."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, DIGEST), F.lpad(F.lower(F.hex(F.length(text))), CODE - DIGEST, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """One row (conv_id, codes) per conversation, in order."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_code(F.col("role"), F.col("text")).alias("code")).alias("t"),
    )
    # Sorted as structs, so a NULL turn is first.
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["code"].alias("codes"))


def rebuilt(own: DataFrame, hundred: int = 100, modulus: int = _HEAD + 1) -> DataFrame:
    """(conv_id, path): the first h turns of the hundred's conversation, then the own ones after h."""
    if not 1 <= modulus <= _HEAD + 1:
        raise ValueError(f"at most {_HEAD} turns come from another conversation")
    heads = own.where(F.col("conv_id") % hundred == 0).select(
        F.col("conv_id").alias("source"), F.slice("codes", 1, _HEAD).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % modulus).cast("int")
    rest = F.filter("codes", lambda _, i: i >= F.col("h"))
    first = F.filter(F.coalesce("head", F.array().cast("array<string>")), lambda _, i: i < F.col("h"))
    return (
        own.select("*", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % hundred).alias("source"))
        .join(heads, "source", "left")
        .select("conv_id", F.array_join(F.concat(first, rest), "").alias("path"))
    )


def _pieces(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (path, conv_id) as a row for every ``size`` ids of a path."""
        path, ids = None, []

        def row() -> tuple:
            return path, ids[0], len(ids), ",".join(map(str, ids))

        for batch in batches:
            made = []
            for p, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != path or len(ids) == size:
                    if ids:
                        made.append(row())
                    path, ids = p, []
                ids.append(i)
            if made:
                yield _rows(made, _PIECES)
        if ids:
            yield _rows([row()], _PIECES)

    return run


_PIECES = "path string, conv_id long, n long, ids string"
_PATHS = "shard long, path string, conv_id long, n long, ends string"
_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _rows(made: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [part.split() for part in ddl.split(", ")]
    columns = list(zip(*made)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (path, conv_id) as one row a path, with the digest of all its ids."""
    shard = TaskContext.get().partitionId()
    path = least = digest = None
    n = 0
    for batch in batches:
        made = []
        for p, i, size, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if p == path:
                n += size
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                made.append((shard, path, least, n, digest.hexdigest()))
            path, least, n, digest = p, i, size, hashlib.sha256(ids.encode())
        if made:
            yield _rows(made, _PATHS)
    if digest is not None:
        yield _rows([(shard, path, least, n, digest.hexdigest())], _PATHS)


class TernaryTree:
    """A ternary search tree over sequences of numbers, built from sorted sequences.

    ``eq`` of a node leads to the tree of what follows its number, ``lo`` and ``hi`` to
    smaller and larger numbers at the same place.
    """

    def __init__(self, keys: list[list[int]]) -> None:
        self.number: list[int] = []
        self.lo: list[int] = []
        self.eq: list[int] = []
        self.hi: list[int] = []
        self.root = -1
        #: The node where each sequence ends; -1 for the one without turns.
        self.ends = [-1] * len(keys)
        stretches = [(0, len(keys))]
        while stretches:
            a, b = stretches.pop()
            if a < b:
                middle = (a + b) // 2
                self.ends[middle] = self._insert(keys[middle])
                stretches += [(middle + 1, b), (a, middle)]

    def _node(self, number: int) -> int:
        self.number.append(number)
        for links in (self.lo, self.eq, self.hi):
            links.append(-1)
        return len(self.number) - 1

    def _insert(self, key: list[int]) -> int:
        at, links, link = -1, None, self.root
        for number in key:
            # ``link`` is the tree at this place, reached through links[at].
            while link >= 0 and self.number[link] != number:
                at, links = link, self.lo if number < self.number[link] else self.hi
                link = links[at]
            if link < 0:
                link = self._node(number)
                if links is None:
                    self.root = link
                else:
                    links[at] = link
            at, links = link, self.eq
            link = self.eq[at]
        return at

    def listed(self) -> Iterator[tuple[int, int]]:
        """Every node with the node before it in its sequences (-1: none), parents first."""
        stack = [(self.root, -1)]
        while stack:
            node, parent = stack.pop()
            if node >= 0:
                yield node, parent
                stack += [(self.lo[node], parent), (self.hi[node], parent), (self.eq[node], node)]


@dataclass
class Border:
    """How many first turns a shard's first path shares with the path before, its last with the one after."""

    before: int
    after: int


def _shared(a: str, b: str | None) -> int:
    """Equal first turns of two paths; -1 without a second path."""
    if b is None:
        return -1
    n, most = 0, min(len(a), len(b)) // CODE
    while n < most and a[n * CODE : (n + 1) * CODE] == b[n * CODE : (n + 1) * CODE]:
        n += 1
    return n


_NODES = (
    "shard long, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, border boolean, parent_border boolean"
)
ROOT_KEY = hashlib.sha256(b"").hexdigest()[:DIGEST]
_NO_IDS = hashlib.sha256(b"").hexdigest()


def shard_nodes(shard: int, paths: list[tuple[str, int, int, str]], border: Border) -> Iterator[tuple]:
    """The trie nodes of one shard's paths (path, conv_id, n, ends), sorted by path.

    A node that other shards have as well, or may have, is a border row: what this shard
    adds to its sums.
    """
    split = [[p[i : i + CODE] for i in range(0, len(p), CODE)] for p, *_ in paths]
    codes = sorted({c for s in split for c in s})
    place = {c: i for i, c in enumerate(codes)}
    tree = TernaryTree([[place[c] for c in s] for s in split])

    # Trie nodes by their place in the list; 0 is the root.
    order = list(tree.listed())
    index = {node: i + 1 for i, (node, _) in enumerate(order)} | {-1: 0}
    size = len(order) + 1
    parent, depth, key = [-1] * size, [0] * size, [ROOT_KEY] * size
    length = [0] * size
    for i, (node, before) in enumerate(order, 1):
        code, up = codes[tree.number[node]], index[before]
        parent[i], depth[i], length[i] = up, depth[up] + 1, int(code[DIGEST:], 16)
        key[i] = hashlib.sha256((key[up] + code).encode()).hexdigest()[:DIGEST]
    members, least, ends = [0] * size, [None] * size, [None] * size
    for end, (_, conv_id, n, digest) in zip(tree.ends, paths):
        i = index[end]
        members[i], least[i], ends[i] = n, conv_id, digest

    # What other shards have, too: prefixes of the first path and of the last one.
    earlier, later = [False] * size, [False] * size
    for end, most, marks in ((0, border.before, earlier), (-1, border.after, later)):
        i = index[tree.ends[end]]
        while i >= 0:
            marks[i] = depth[i] <= most
            i = parent[i]

    children, leaves, saved = [0] * size, [0] * size, [0] * size
    childless = [True] * size
    for i in range(1, size):
        childless[parent[i]] = False
    # The next shard goes on where the last path ends.
    last = index[tree.ends[-1]]
    childless[last] &= depth[last] != border.after
    for i in range(size - 1, -1, -1):
        leaves[i] += childless[i] and not earlier[i]
        up = parent[i]
        saved[i] += length[i] * (members[i] - (not earlier[i]))
        if up >= 0:
            members[up] += members[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
            children[up] += not earlier[i]
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    shared = [a or b for a, b in zip(earlier, later)]
    for i in range(size):
        up = parent[i]
        above = up >= 0 and shared[up]
        yield (
            shard, key[i], key[up] if up >= 0 else None, least[i], depth[i],
            least[up] if up >= 0 and not above else None, members[i], children[i], leaves[i], saved[i],
            ends[i], shared[i], above,
        )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, kind, path): a shard's neighbours, then its paths; its nodes."""
    shard, around, paths = None, None, []

    def made() -> Iterator[pa.RecordBatch]:
        if not paths:
            return
        border = Border(_shared(paths[0][0], around[0]), _shared(paths[-1][0], around[1]))
        rows = []
        for row in shard_nodes(shard, paths, border):
            rows.append(row)
            if len(rows) == _ROWS:
                yield _rows(rows, _NODES)
                rows = []
        if rows:
            yield _rows(rows, _NODES)

    for batch in batches:
        for number, kind, path, conv_id, n, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                yield from made()
                shard, around, paths = number, (path, ends), []
            else:
                paths.append((path, conv_id, n, ends))
    yield from made()


_ROWS = 10_000


def nodes(
    members: DataFrame, space: Workspace, shard_rows: int = SHARD_ROWS, piece_ids: int = PIECE_IDS
) -> DataFrame:
    """The trie over (conv_id, path): a row per distinct prefix of paths."""
    spark = space.spark
    members = space.step(members.select("path", "conv_id"))
    by = ["path", "conv_id"]
    pieces = space.step(
        map_parts(members.repartitionByRange(*by).sortWithinPartitions(*by), _pieces(piece_ids), _PIECES)
    )
    size = pieces.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("path")), F.lit(0)).alias("chars")).first()
    shards = 1 + max(size["rows"] // shard_rows, size["chars"] // SHARD_CHARS)
    paths = space.step(
        map_parts(pieces.repartitionByRange(shards, "path").sortWithinPartitions(*by), _paths, _PATHS)
    )

    # A shard's neighbours; shards that got no path have none, so numbers may have gaps.
    edges = space.step(paths.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")))
    numbers = sorted(r["shard"] for r in edges.select("shard").collect())  # as many as partitions
    beside = spark.createDataFrame(
        list(zip(numbers, [None, *numbers[:-1]], [*numbers[1:], None])), "shard long, before long, after long"
    )
    around = (
        beside.join(edges.select(F.col("shard").alias("before"), "last"), "before", "left")
        .join(edges.select(F.col("shard").alias("after"), "first"), "after", "left")
        .select("shard", F.lit(0).alias("kind"), F.col("last").alias("path"), F.lit(None).cast("long").alias("conv_id"),
                F.lit(None).cast("long").alias("n"), F.col("first").alias("ends"))
    )
    rows = paths.select("shard", F.lit(1).alias("kind"), "path", "conv_id", "n", "ends").unionByName(around)
    made = space.step(
        map_parts(rows.repartition("shard").sortWithinPartitions("shard", "kind", "path"), _shards, _NODES)
    )

    # What shards share along their borders, added up.
    parts = made.where("border")
    merged = space.step(
        parts.groupBy("key").agg(
            F.max("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256"),
        )
    )
    least = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # A border node's children are in its shards, so no key has more rows than a shard.
    in_shard = parts.select("shard", F.col("key").alias("parent_key")).join(least, "parent_key")
    inner = made.where("NOT border")
    below = inner.where("parent_border").drop("parent_conv_id").join(in_shard, ["shard", "parent_key"])
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
    ]
    return (
        inner.where("NOT parent_border").select(*columns)
        .unionByName(below.select(*columns))
        .unionByName(merged.join(least, "parent_key", "left").select(*columns))
    )
