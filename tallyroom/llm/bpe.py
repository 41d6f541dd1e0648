"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary tells whether a whole
pre-token is a token.  Tier two, for the others: the bytes of the pre-token form
a linked list, and a heap of adjacent pairs by rank is merged until no pair is
in the vocabulary.  Both tiers use the same hash, so a task holds the vocabulary
once.  The vocabulary is a rank file given by path; it is read by the driver and
sent to the tasks only within ``MAX_VOCABULARY`` entries.  Tokenizers are never
trained here.

Defined results: NULL and empty texts encode to no ids and decode to no bytes;
repeated rows and NULL ids are encoded like any row; a NULL or empty list of ids
decodes to no bytes; an unknown id fails.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tallyroom.llm.common import map_parts, values

MAX_VOCABULARY = 1 << 20
#: Pre-tokens that a worker remembers; when full, the later half is forgotten, since
#: frequent ones come early.  Parts of them are forgotten altogether.
CACHE = 400_000
PARTS = 200_000
_BUCKET = 4
_M64 = (1 << 64) - 1
# Fixed value: a pattern by which a blank between two visible characters always opens a
# pre-token, so that a text can be taken apart at such blanks before it is matched.
_BLANK_OPENS = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
}
_MARKS = set(".,;:!?)]}\"")
_NEAR_BLANK = re.compile(r" \s|\s ")
_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_WIDE_SPACES = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def _blanks_stand_alone(text: str) -> bool:
    """Whether every blank has visible characters on both sides, or an end of the text."""
    if "  " in text or " \n" in text or "\n " in text:
        return False
    if any(c in text for c in _SPACES) or not text.isascii() and any(c in text for c in _WIDE_SPACES):
        return not _NEAR_BLANK.search(text)
    return True


_NEXT, _LAST = list(range(1, 65)), list(range(-1, 63))


def _slot(digest: int, displacement: int, size: int) -> int:
    x = (digest ^ displacement) * (2 * displacement + 0x9E3779B97F4A7C15) & _M64
    return (x >> 24) % size


class PerfectHash:
    """Minimal perfect hash by displacement: n keys take the slots 0 to n-1.

    Keys fall in small buckets; large buckets first, each gets a displacement
    that puts all its keys in free slots.  A bucket of one key names its slot
    (stored as -slot-1).  A slot keeps its key, so foreign keys are told apart.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = len(ranks)
        self.buckets = max(1, self.size // _BUCKET)
        grouped: dict[int, list[tuple[int, bytes]]] = {}
        for key in ranks:
            digest = xxhash.xxh3_64_intdigest(key)
            grouped.setdefault((digest >> 32) % self.buckets, []).append((digest, key))
        self.displacement = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        single = []
        for bucket, members in sorted(grouped.items(), key=lambda kv: (-len(kv[1]), kv[0])):
            if len(members) == 1:
                single.append((bucket, members[0][1]))
                continue
            d = 0
            while True:
                slots = [_slot(digest, d, self.size) for digest, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.displacement[bucket] = d
            for slot, (_, key) in zip(slots, members):
                self.keys[slot] = key
        free = (i for i, key in enumerate(self.keys) if key is None)
        for bucket, key in single:
            slot = next(free)
            self.displacement[bucket] = -slot - 1
            self.keys[slot] = key
        self.ranks = [ranks[key] for key in self.keys]

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        digest = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[(digest >> 32) % self.buckets]
        slot = -d - 1 if d < 0 else _slot(digest, d, self.size)
        return self.ranks[slot] if self.keys[slot] == key else None


def merge_bytes(word: bytes, ranks, pairs, single) -> list[int]:
    """Ids of a pre-token: the lowest-ranked pair is merged first, the left one on ties.

    ``ranks[part]`` is a part's rank or -1; ``pairs[a][b]`` and ``single[a]``
    are those of two bytes and of one.  Part i spans word[i:after[i]].  A heap
    entry packs (rank, i, stop) into one integer; it is stale unless the part at
    i and the one after it still span word[i:stop] together.
    """
    n = len(word)
    after = _NEXT[:n] if n < len(_NEXT) else list(range(1, n + 1))
    before = _LAST[:n] if n < len(_LAST) else list(range(-1, n - 1))
    ids = [single[b] for b in word]
    shift = n.bit_length()
    mask, far, step = (1 << shift) - 1, 2 * shift, (1 << shift) + 1
    heap = [
        r << far | i * step + 2
        for i, (a, b) in enumerate(zip(word, word[1:]))
        if (r := pairs[a][b]) >= 0
    ]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i, stop = entry >> shift & mask, entry & mask
        middle = after[i]  # 0 once the part at i is gone
        if not middle or middle >= n or after[middle] != stop:
            continue
        after[i], after[middle] = stop, 0
        ids[i], ids[middle] = entry >> far, -1
        if stop < n:
            before[stop] = i
            end = after[stop]
            r = ranks[word[i:end]]
            if r >= 0:
                heappush(heap, r << far | i << shift | end)
        left = before[i]
        if left >= 0:
            r = ranks[word[left:stop]]
            if r >= 0:
                heappush(heap, r << far | left << shift | stop)
    return [x for x in ids if x >= 0]


class _Parts(dict):
    """Ranks by part of a pre-token, looked up in the perfect hash once."""

    def __init__(self, table: PerfectHash) -> None:
        super().__init__()
        self.look_up = table.get

    def __missing__(self, part: bytes) -> int:
        if len(self) >= PARTS:
            self.clear()
        rank = self.look_up(part)
        self[part] = rank = -1 if rank is None else rank
        return rank


class _Kept(dict):
    """What a worker remembers; when full, the later half is forgotten."""

    def keep(self, key: str, value: bytes) -> bytes:
        if len(self) >= CACHE:
            for late in list(islice(self, CACHE // 2, None)):
                del self[late]
        self[key] = value
        return value


class _Pieces(_Kept):
    """Ids, as bytes of 32-bit integers, by pre-token; what is missing goes through both tiers."""

    def __init__(self, table: PerfectHash) -> None:
        super().__init__()
        self.look_up, self.parts = table.get, _Parts(table)
        self.single = [self.parts[bytes([a])] for a in range(256)]
        self.gaps = {a for a in range(256) if self.single[a] < 0}
        self.pairs = [[self.parts[bytes((a, b))] for b in range(256)] for a in range(256)]

    def ids_of(self, piece: str) -> bytes:
        word = piece.encode("utf-8", "replace")
        whole = self.look_up(word)
        if whole is None:
            if self.gaps and not self.gaps.isdisjoint(word):
                raise ValueError(f"the vocabulary lacks a byte of {word!r}")
            return array("i", merge_bytes(word, self.parts, self.pairs, self.single)).tobytes()
        return array("i", [whole]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        return self.keep(piece, self.ids_of(piece))


class _Chunks(_Kept):
    """Ids of a blank and the visible characters after it, by the latter.

    Letters after the blank are one pre-token, and a mark after them is another.
    """

    def __init__(self, pieces: _Pieces, split) -> None:
        super().__init__()
        self.pieces, self.split = pieces, split

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.keep(chunk, self.pieces.ids_of(f" {chunk}"))
        letters, last = chunk[:-1], chunk[-1:]
        if last in _MARKS and letters.isalpha():
            return self.keep(chunk, self[letters] + self.pieces[last])
        parts = self.split(f" {chunk}")
        return self.keep(chunk, b"".join(map(self.pieces.__getitem__, parts)))


class Tokenizer:
    """A vocabulary with its pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if len(ranks) > MAX_VOCABULARY:
            raise ValueError(f"vocabulary of {len(ranks)} entries; at most {MAX_VOCABULARY}")
        self.table = PerfectHash(ranks)
        self.pattern = pattern
        self._ready()

    def _ready(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.pieces = _Pieces(self.table)
        self.chunks = _Chunks(self.pieces, self.split)
        self.by_blank = self.pattern in _BLANK_OPENS
        self.bytes_of = np.full(max(self.table.ranks, default=-1) + 1, None, object)
        self.bytes_of[self.table.ranks] = self.table.keys

    def __getstate__(self) -> dict:
        return {"table": self.table, "pattern": self.pattern}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, 32-bit integers."""
        text = text or ""
        if self.by_blank and _blanks_stand_alone(text):
            first, *rest = text.split(" ")
            found = [*map(self.pieces.__getitem__, self.split(first)), *map(self.chunks.__getitem__, rest)]
        else:
            found = map(self.pieces.__getitem__, self.split(text))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() < 0:
            raise IndexError("ids are not negative")
        return b"".join(self.bytes_of[ids].tolist())


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file: a base64 token and its rank on each line."""
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return Tokenizer(ranks, pattern)


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *ids])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""
    return _encoded(docs, tokenizer, False)


def round_trip(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, ids, and the bytes decoded from the ids, without sending the ids to and fro."""
    return _encoded(docs, tokenizer, True)


def _encoded(docs: DataFrame, tokenizer: Tokenizer, decoded: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        own = sent.value
        for batch in batches:
            ids = [own.encode(t) for t in values(batch, "text")]
            columns = [
                batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()), _id_lists(ids)
            ]
            if decoded:
                columns.append(pa.array(map(own.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return map_parts(docs.select("doc_id", "text"), run, schema)


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            decoded = [
                sent.value.decode(x.values.to_numpy()) if x.is_valid and len(x) else b"" for x in lists
            ]
            yield pa.RecordBatch.from_arrays(
                [*itemgetter(0, 1)(batch.columns), pa.array(decoded, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    return map_parts(
        encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary"
    )
