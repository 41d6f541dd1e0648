"""Exact Jaccard join of word n-grams by a partitioned universe.

A text's set holds its distinct shingles of ``WORDS`` words (64-bit hashes).  Two
sets x and y link when |x & y| >= t |x | y| for t = 3/4, so they differ in at most
H = (|x| + |y|) / 7 elements.

Size bands: band b holds sizes from 4**b to 4**(b+1) / t, so every two sizes that
can link share a band.  A band cuts the universe of hashes into segments; a set's
subset in a segment gets one signature.  As at most H segments differ, two linked
sets that both list p = H + k signatures in a common order share at least k of
them.  Which p of its segments a set lists is a matter of cost: frequent
signatures (a table of at most ``MAX_HEAVY``, counted over all texts) come last
in the order.  Sets of up to 7 shingles, whose partners can differ in one element
only, list the whole set and its one-deletion neighbourhood instead, and sets of
6 or more the segments too.  A set with too few occupied segments also lists its
single shingles.

Signatures meet by one shuffle, sorted, and stream past; only sets of sizes that can
link meet.  A signature of up to ``BUCKET`` sets names pairs; pairs that share fewer
signatures than k allows are dropped.  Larger ones are left out for a set unless it
has so many that it could link through them alone.  What remains connects candidate
groups.  A group is cut into blocks; a task takes two blocks of texts, counts the
overlaps of their sets exactly, and gives the links that connect them.  Links of all
tasks form the classes.  Equal sets are one node, the hash of the set, from the start,
so copies are never paired with each other, and no task holds more than two blocks.

Defined results: without words (NULL, empty) a text has no shingles and links
with nothing; with fewer than ``WORDS`` words all of them form one shingle.
Repeated rows get equal results.  Rows that repeat a doc_id with another text are
one document with the links of all its texts.  A row without a doc_id takes part
in links; its component is the smallest doc_id among those it links to, NULL if
there is none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace, map_parts
from tallyroom.llm.components import components

WORDS = 5
#: Similarity of a link, in hundredths.
PERCENT = 75
MAX_HEAVY = 1 << 16
#: A signature with more texts than this is large.
BUCKET = 32
#: Texts of a block, about, and words a task remembers.
BLOCK = 512
CACHE = 300_000
#: Bits of the marks for each id that is looked for, about, and in all (16 MB).
MARKS, MAX_MARKS = 16, 1 << 27
_CHUNK = 2_000_000
_LOCAL = 6
_WHOLE_MAX, _SEGMENT_MIN = 7, 6
#: Ids that stand for rows without a doc_id begin here.
NO_ID = 1 << 62

_FACTORS = [
    np.uint64(x)
    for x in (
        0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
        0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9,
    )
]
_U32 = np.uint64(32)
# bytes.lower and bytes.split know A-Z and the six blanks 0x20, 0x09-0x0D only.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Words of up to this many bytes are hashed side by side, eight bytes at a time.
_SHORT = 64
#: What is kept of eight bytes of which so many are the word's.
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[3]
    return x ^ (x >> np.uint64(29))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(texts: pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the places where each text's begin and end."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    edge = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[edge[0] : edge[-1]]
    edge, n = edge - edge[0], len(raw)
    held = np.zeros(n + 8, np.uint8)  # eight bytes can be read at any place
    held[:n] = _LOWER[raw]
    inside = np.zeros(n + 2, bool)  # at i + 1: whether byte i is in a word
    inside[1:-1] = ~_BLANK[raw]
    before, after = inside[:-1].copy(), inside[1:].copy()
    before[edge] = after[edge] = False  # a word ends with its text
    start = np.flatnonzero(inside[1:-1] & ~before[:-1])
    end = np.flatnonzero(inside[1:-1] & ~after[1:]) + 1

    size = end - start
    h = size.astype(np.uint64)
    eight = np.ndarray(n + 1, "<u8", held, strides=(1,))
    rows, at = np.flatnonzero(size <= _SHORT), 0
    while len(rows):
        left = size[rows] - at
        part = eight[start[rows] + at] & _KEPT[np.minimum(left, 8)]
        h[rows] = _mix((h[rows] ^ part) * _FACTORS[0])
        rows, at = rows[left > 8], at + 8
    for i in np.flatnonzero(size > _SHORT).tolist():
        h[i] = words[held[start[i] : end[i]].tobytes()]
    return h, np.searchsorted(start, edge)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted; for the many short arrays of a task this is faster than np.unique."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values if fresh.all() else values[fresh]


def shingle_sets(texts: pa.Array, words: _Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the words of all are worked on side by side."""
    h, edge = word_hashes(texts, words)
    # Runs of words from any place on; those that reach into the next text are not looked at.
    runs = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        runs += h[i : len(runs) + i] * _FACTORS[i]
    runs = _mix(runs)
    sets = []
    for begin, end in zip(edge[:-1].tolist(), edge[1:].tolist()):
        width = end - begin
        if width >= WORDS:
            sets.append(_distinct(runs[begin : end - WORDS + 1]))
        elif width:  # a sequence of another length is another shingle
            parts = (h[begin:end] + np.uint64(width)) * np.array(_FACTORS[:width])
            sets.append(_mix(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def shingles(text: str | None, words: _Words) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return shingle_sets(pa.array([(text or "").encode("utf-8", "replace")], pa.binary()), words)[0]


def needed(size: int) -> tuple[int, int]:
    """The most segments that can differ from a partner's, and the spare signatures."""
    # A partner has at most size / t shingles: H = (size + 4 size / 3) / 7 = size / 3.
    return size // 3, max(1, size // 10)


def _whole(s: np.ndarray) -> np.ndarray:
    total = _mix(s).sum(dtype=np.uint64)
    out = np.concatenate([[total], total - _mix(s)]) if len(s) > 1 else np.array([total])
    return _mix(out + np.uint64(0x51))


def _segments(s: np.ndarray) -> list[np.ndarray]:
    """Signatures of the occupied segments, for each size band of the set."""
    out = []
    n = len(s)
    top = 0
    while 4 ** (top + 1) <= n:
        top += 1
    for band in (top, top - 1):
        largest = 4 ** (band + 1) * 100 // PERCENT
        if band < 0 or n > largest:
            continue
        at = (s >> _U32) * np.uint64(2 * largest) >> _U32
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums = np.add.reduceat(_mix(s), first)
        out.append(_mix(sums + _FACTORS[0] * at[first] + np.uint64(0xB5297A4D3F84 * (band + 1))))
    return out


def promise(n: int, segments: list[np.ndarray]) -> int:
    """How many listed signatures a set of n shingles shares at least with any linked set."""
    if n <= _WHOLE_MAX:
        return 1
    differ, spare = needed(n)
    return max(1, min(spare, *(len(sig) - differ for sig in segments)))


def signatures(s: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """What a set lists."""
    n = len(s)
    listed = []
    if n <= _WHOLE_MAX:
        listed.append(_whole(s))
    if n >= _SEGMENT_MIN:
        differ, spare = needed(n)
        want = differ + spare
        for sig in _segments(s):
            if len(sig) <= differ:
                listed.append(_mix(s + np.uint64(0x7)))
            elif len(sig) > want:
                dear = np.zeros(len(sig), bool)
                if len(heavy):
                    dear = heavy[np.minimum(np.searchsorted(heavy, sig), len(heavy) - 1)] == sig
                cheap = sig[~dear]
                if len(cheap) >= want:
                    sig = np.partition(cheap, want - 1)[:want]
                else:
                    rest, more = sig[dear], want - len(cheap)
                    sig = np.concatenate([cheap, np.partition(rest, more - 1)[:more]])
            listed.append(sig)
    return np.concatenate(listed)


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True)


_PROFILE_DDL = "id long, doc_id long, n long, node long, shared long, sig long, times long"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows (sig, times) of signatures frequent within a stretch."""
    words, none = _Words(), np.empty(0, np.uint64)
    held: list[np.ndarray] = []
    size = 0

    def frequent() -> pa.RecordBatch:
        sig, times = np.unique(np.concatenate([none, *held]), return_counts=True)
        often = times >= _LOCAL
        sig, times = sig[often].view(np.int64), times[often]
        empty = pa.nulls(len(sig), pa.int64())
        return pa.RecordBatch.from_arrays([empty] * 5 + [pa.array(sig), pa.array(times)], names=names)

    names = [c.split()[0] for c in _PROFILE_DDL.split(", ")]
    seen: set[int] = set()
    for batch in batches:
        rows = []
        sets = shingle_sets(batch.column(2), words)
        for row_id, doc_id, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets):
            node = _node(s)
            found = _segments(s) if len(s) >= _SEGMENT_MIN else []
            rows.append((row_id, doc_id, len(s), node, promise(len(s), found)))
            if found and node not in seen:
                seen.add(node)
                held += found
                size += sum(map(len, found))
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.nulls(0, pa.int64())] * 5
        blank = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays([*columns, blank, blank], names=names)
        if size >= _CHUNK:
            yield frequent()
            held, size = [], 0
    if held:
        yield frequent()


def _list_signatures(heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        for batch in batches:
            sigs, nodes, ns, sizes = [np.empty(0, np.uint64)], [], [], []
            for s in shingle_sets(batch.column(0), words):
                node = _node(s)
                if len(s) and node not in seen:
                    seen.add(node)
                    sigs.append(signatures(s, heavy))
                    nodes.append(node)
                    ns.append(len(s))
                    sizes.append(len(sigs[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(sigs).view(np.int64)),
                    pa.array(np.repeat(np.array(nodes, np.int64), sizes), pa.int64()),
                    pa.array(np.repeat(np.array(ns, np.int32), sizes), pa.int32()),
                ],
                names=["sig", "node", "n"],
            )

    return run


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sig, those that meet a set of a size they can link with.

    ``large`` tells whether the signature has more than BUCKET nodes; all rows of such a one
    stay, and one that copies list in several tasks may come several times.
    """
    rest = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))
    large_sig: int | None = None

    def emit(sig: np.ndarray, nodes: np.ndarray, ns: np.ndarray, known_large: int | None):
        # Most signatures have one row, and only the others are put in order.
        again = sig[1:] == sig[:-1]
        several = np.zeros(len(sig), bool) if known_large is None else sig == known_large
        several[1:] |= again
        several[:-1] |= again
        sig, nodes, ns = sig[several], nodes[several], ns[several]
        order = np.lexsort((nodes, ns, sig))
        sig, nodes, ns = sig[order], nodes[order], ns[order]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (nodes[1:] != nodes[:-1])
        sig, nodes, ns = sig[fresh], nodes[fresh], ns[fresh]
        if not len(sig):
            return None
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([first, [len(sig)]]))
        large = size > BUCKET
        if known_large is not None:
            large |= sig[first] == known_large
        keep = np.repeat(large, size)
        large = keep.copy()
        # In order of size the nearest sizes are the neighbours.
        wide = ns.astype(np.int64)
        meets = (sig[1:] == sig[:-1]) & (100 * wide[:-1] >= PERCENT * wide[1:])
        keep[1:] |= meets
        keep[:-1] |= meets
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (sig, nodes, ns, large)], names=["sig", "node", "n", "large"]
        )

    for batch in batches:
        sig, nodes, ns = (
            np.concatenate([old, new.to_numpy(zero_copy_only=False)]) for old, new in zip(rest, batch.columns)
        )
        if not len(sig):
            continue
        # The last signature may go on in the next batch; a large one need not wait.
        cut = int(np.searchsorted(sig, sig[-1], "left"))
        tail = len(np.unique(nodes[cut:]))
        if tail > BUCKET or (large_sig is not None and sig[-1] == large_sig):
            done, cut = emit(sig, nodes, ns, large_sig), len(sig)
            large_sig = int(sig[-1])
        else:
            done = emit(sig[:cut], nodes[:cut], ns[:cut], large_sig)
            large_sig = None
        rest = (sig[cut:], nodes[cut:], ns[cut:])
        if done is not None and done.num_rows:
            yield done
    done = emit(*rest, large_sig)
    if done is not None and done.num_rows:
        yield done


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def tile_links(sets: list[np.ndarray], left: list[bool], same: bool) -> list[tuple[int, int]]:
    """Links, enough to connect what they connect, between the left and right sets (or all)."""
    n = len(sets)
    parent, made = list(range(n)), []

    def link(a: int, others: np.ndarray, overlap: np.ndarray) -> None:
        union = len(sets[a]) + sizes[others] - overlap
        for b in others[100 * overlap >= PERCENT * union].tolist():
            x, y = _find(parent, a), _find(parent, b)
            if x != y:
                parent[x] = y
                made.append((a, b))

    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else value[:0]
    times = np.diff(np.concatenate([first, [len(value)]])).astype(np.int64)
    start = np.empty(len(value), np.int64)  # of each element: its run of equal elements
    count = np.empty(len(value), np.int64)
    start[order], count[order] = np.repeat(first, times), np.repeat(times, times)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    is_left = np.array(left, bool)
    for a in range(n):
        if not is_left[a]:
            continue
        begin, many = start[edge[a] : edge[a + 1]], count[edge[a] : edge[a + 1]]
        begin, many = begin[many > 1], many[many > 1]
        if not len(many):
            continue
        places = np.repeat(begin - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        overlap = np.bincount(owner[places + np.arange(len(places))], minlength=n)
        overlap[a if not same else slice(0, a + 1)] = 0
        if not same:
            overlap[is_left] = 0
        others = np.flatnonzero(overlap)
        link(a, others, overlap[others])
    return made


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each tile; rows (label, low, high, block, id, text) come sorted by tile."""
    words = _Words()
    key, ids, left, sets, last = None, [], [], [], None
    out: list[tuple[int, int]] = []

    def close() -> None:
        if len(ids) > 1:
            out.extend((ids[a], ids[b]) for a, b in tile_links(sets, left, key[1] == key[2]))

    def batch_of(rows) -> pa.RecordBatch:
        u, v = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        found = shingle_sets(batch.column(5), words)
        for label, low, high, block, row_id, text, s in zip(*(c.to_pylist() for c in batch.columns), found):
            if (label, low, high) != key:
                close()
                key, ids, left, sets, last = (label, low, high), [], [], [], None
            if (row_id, text) == last:  # a repeated row
                continue
            last = (row_id, text)
            ids.append(row_id)
            left.append(block == low)
            sets.append(s)
        if len(out) > 10_000:
            yield batch_of(out)
            out.clear()
    close()
    if out:
        yield batch_of(out)


def _id() -> Column:
    """The doc_id, or a large number that stands for the text."""
    spare = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(NO_ID)) + F.lit(NO_ID)
    return F.coalesce(F.col("doc_id").cast("long"), spare)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_id().alias("id"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def classes(docs: DataFrame, space: Workspace) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    rows, labels = _labelled(docs, space)
    return rows.join(labels, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id"))
        .when(F.col("label") < NO_ID, F.col("label"))
        .alias("component_id"),
    )


def representatives(docs: DataFrame, space: Workspace) -> DataFrame:
    """One whole row of ``docs``, all columns, of each class: one with its smallest doc_id.

    Rows without words are no class and all stay.  Of rows that repeat the
    smallest doc_id, the one with the smallest text stays.
    """
    rows, labels = _labelled(docs, space)
    ids = space.step(
        rows.join(labels, "node").groupBy("id").agg(F.min("label").alias("label"), F.count("*").alias("rows"))
    )
    taken = {c.lower() for c in docs.columns}
    name, other, rank_name = (_unused(n, taken) for n in ("id", "other", "rank"))
    keyed = docs.withColumn(name, _id())
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))

    def of(part: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        part = part.select(F.col("id").alias(other))
        return rows.join(part, (F.col(name) == F.col(other)) & worded, how)

    kept = of(ids.where("id <> label"), "left_anti", keyed)
    several = space.step(ids.where("id = label AND rows > 1"))
    if not several.isEmpty():
        rank = F.row_number().over(W.partitionBy(name).orderBy("text"))
        one = of(several, "left_semi", kept).withColumn(rank_name, rank)
        kept = of(several, "left_anti", kept).unionByName(one.where(F.col(rank_name) == 1).drop(rank_name))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _unused(name: str, taken: set[str]) -> str:
    """A column name that differs from the taken ones, whatever their case."""
    while name in taken:
        name += "_"
    return name


def _heavy(counts: DataFrame, space: Workspace) -> np.ndarray:
    """The most frequent signatures with more than BUCKET texts, MAX_HEAVY at most."""
    often = space.step(counts.where(F.col("times") > BUCKET))
    steps = often.groupBy(F.floor(F.log2("times") * 8).alias("step")).count().collect()  # 512 at most
    total, least = 0, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["count"]
        if total > MAX_HEAVY:
            least = row["step"] + 1
            break
    kept = often.where(F.floor(F.log2("times") * 8) >= least).select("sig").collect()
    return np.sort(np.array([r["sig"] for r in kept], np.int64).view(np.uint64))


def _least_partner(n: Column) -> Column:
    """What the smallest set that n shingles can be linked with promises, unless it is odd."""
    smallest = F.ceil(n * PERCENT / 100)
    return F.when(smallest <= _WHOLE_MAX, 1).otherwise(F.greatest(F.lit(1), F.floor(smallest / 10)))


def _candidates(shared: DataFrame, owners: DataFrame, space: Workspace) -> DataFrame:
    """Links (u, v) between nodes that lead from any set to all it may be linked to."""
    # Dealt by set once: what is known of a set and the numbers by set need no more; the
    # plan is the same whatever the number of sets.
    rows = shared.hint("merge").join(owners.select("node", "shared", "partners"), "node")
    # How many of a set's signatures are shared at all, and how many widely.
    # A pair shares the smaller promise of its two at least, so a set needs as many as its
    # smallest partner may promise.
    odd = owners.where("shared < partners").select("node")
    if not odd.isEmpty():
        # Texts whose shingles fell into too few segments promise less than their size does;
        # their partners, told by a signature, need no more than them.
        beside = rows.join(odd, "node", "left_semi").select("sig").distinct()
        beside = space.step(rows.join(beside, "sig", "left_semi").select("node").distinct())
        fewer = beside.select("node", F.lit(1).alias("fewer"))
        rows = space.step(
            rows.join(fewer, "node", "left")
            .withColumn("partners", F.coalesce("fewer", "partners"))
            .drop("fewer")
        )
    own = W.partitionBy("node")
    rows = space.step(
        rows.withColumn("all", F.count("*").over(own))
        .withColumn("widely", F.sum(F.col("large").cast("long")).over(own))
        .where(F.col("all") >= F.col("partners"))
        .drop("all")
    )
    # Small signatures: pairs of sizes that can link, with the number they share.
    small = (
        rows.where(~F.col("large"))
        .repartition("sig")  # as rows, of which those of a set are side by side; few meet before
        .groupBy("sig")
        .agg(F.sort_array(F.collect_list(F.struct("node", "n", "shared", "widely"))).alias("members"))
        .where(F.size("members") > 1)
        .select("members", F.posexplode("members").alias("at", "a"))
        .select("a", F.explode(F.slice("members", F.col("at") + 2, F.size("members"))).alias("b"))
        .where(100 * F.least("a.n", "b.n") >= PERCENT * F.greatest("a.n", "b.n"))
    )
    least = F.least("a.shared", "b.shared") - F.least("a.widely", "b.widely")
    pairs = (
        small.groupBy(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
        .agg(F.count("*").alias("times"), F.max(least).alias("least"))
        .where(F.col("times") >= F.col("least"))
        .select("u", "v")
    )
    # Large ones: only sets with so many that large ones alone could link them.
    wide = space.step(
        rows.where(F.col("large") & (F.col("widely") >= F.col("partners"))).select("sig", "node")
    )
    first = space.step(wide.groupBy("sig").agg(F.min("node").alias("v")))
    stars = wide.join(first, "sig").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    return pairs.unionAll(stars)


def _marked(rows: DataFrame, ids: DataFrame, space: Workspace) -> DataFrame:
    """Rows whose id may be one of ``ids``: all that are, and a few others.

    The ids are a bit each, ``MARKS`` bits an id and ``MAX_MARKS`` in all at most, which
    are sent to all tasks.
    """
    bits = min(MAX_MARKS, 1 << max(15, (MARKS * ids.count()).bit_length()))

    def at(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_at", F.pmod(F.xxhash64("id"), F.lit(bits)))

    marks = space.step(
        at(ids).groupBy(F.bitmap_bucket_number("_at").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))
    )
    place = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = (
        at(rows).withColumn("_bucket", F.bitmap_bucket_number("_at"))
        .join(F.broadcast(marks), "_bucket")
        .where(byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0)
    )
    return found.select(*rows.columns)


def _verified(texts: DataFrame, groups: DataFrame, owners: DataFrame, space: Workspace) -> DataFrame:
    """Links (u, v) between representatives that hold exactly, enough to connect each class."""
    members = groups.unionAll(groups.select(F.col("label").alias("node"), "label").distinct())
    # A row that repeats an id with another text may represent two sets of a group.
    members = space.step(members.join(owners.select("node", "rep"), "node").select("rep", "label").distinct())
    sizes = members.groupBy("label").agg((F.floor((F.count("*") - 1) / BLOCK) + 1).alias("blocks"))
    sizes = space.step(sizes)
    placed = space.step(
        members.join(sizes, "label").select(
            F.col("rep").alias("id"), "label", "blocks",
            F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"),
        )
    )
    # Most texts are in no group and stay where they are.
    wanted = _marked(texts.select("id", "text"), placed.select("id"), space).join(placed, "id")
    tile = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = (
        wanted.select("id", "text", "label", "block", tile)
        .select(
            "label", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "id", "text",
        )
        .repartition("label", "low", "high")
        .sortWithinPartitions("label", "low", "high", "id", "text")
    )
    return space.step(map_parts(dealt, _tiles, "u long, v long"))


def _labelled(docs: DataFrame, space: Workspace) -> tuple[DataFrame, DataFrame]:
    """Profile rows (id, doc_id, n, node, shared), and the smallest id of each node's class."""
    texts = _texts(docs)

    # One row per document, and which signatures are frequent.
    profile = space.step(map_parts(texts, _profile, _PROFILE_DDL))
    rows = profile.where("id IS NOT NULL").select("id", "doc_id", "n", "node", "shared")
    counts = profile.where("sig IS NOT NULL").groupBy("sig").agg(F.sum("times").alias("times"))
    heavy = _heavy(counts, space)
    worded = rows.where("n > 0")
    owners = space.step(
        worded.groupBy("node").agg(
            F.min("id").alias("rep"),
            F.min("shared").alias("shared"),
            _least_partner(F.max("n")).cast("int").alias("partners"),
        )
    )
    reps = space.step(
        worded.select("id", "node").distinct().join(owners, "node").select("id", "node", "rep")
    )

    # Signatures that several sets share; copies are one set and meet only themselves.
    sent = docs.sparkSession.sparkContext.broadcast(heavy)  # MAX_HEAVY entries at most
    listed = map_parts(
        texts.select("text"),
        lambda batches: _list_signatures(sent.value)(batches),
        "sig long, node long, n int",
    )
    shared = space.step(
        listed.repartition("sig")
        .sortWithinPartitions("sig")  # one number, by radix; the few that meet are put in order later
        .mapInArrow(_shared_rows, "sig long, node long, n int, large boolean")
    )
    links = space.step(_candidates(shared, owners, space))
    found = _verified(texts, components(links, space), owners, space)

    # An id that occurs with several texts holds their classes together.
    several = reps.groupBy("id").count().where("count > 1").select("id")
    held = reps.join(several, "id").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    labels = components(found.unionAll(held), space)
    by_node = space.step(
        reps.select("node", "rep").distinct()
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("node", F.coalesce("label", "rep").alias("label"))
    )
    return rows, by_node
