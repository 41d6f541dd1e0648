"""Benchmark decontamination by an FM-index per training shard.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A phrase is
a window of ``WINDOW`` consecutive words of a benchmark item, or the whole item
if it has fewer words.  Each task cuts its documents into shards of about
``SHARD_WORDS`` words and builds, for a shard: the suffix array of its words (a
separator of its own ends each document), the Burrows-Wheeler transform, its
wavelet matrix, and the suffix positions of every ``SAMPLE``-th word and of each
document's first word.  All phrases are searched backwards at once through the
matrix's ranks; an occurrence is located by stepping back to a sampled position.
Hit words merge into spans.

The documents are read once and nothing is shuffled.  Phrases are sent to the
tasks in slices of at most ``SLICE_WORDS`` benchmark words; a larger benchmark
takes more passes, each of which adds to the spans of the one before.

Defined results: NULL and empty texts have no words; NULL or empty items have no
phrases; a NULL item_id is left out; repeated rows get equal results; equal
phrases of several items count for each of them; without benchmark rows nothing
is hit.  A document larger than a shard is a shard by itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tallyroom.llm.common import Workspace, map_parts

WINDOW = 10
SHARD_WORDS = 1 << 18
SAMPLE = 8
SLICE_WORDS = 2_000_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# A-Z to a-z, digits, a-z and bytes of other scripts as they are, the rest to spaces.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_BYTES).split()


def suffix_array(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Order of all suffixes; the last symbol must occur once.

    First by as many symbols as fit in one integer, then ties by doubling.
    """
    n = len(symbols)
    bits = max(1, int(n_symbols).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(width):
        key <<= bits
        if j < n:
            key[: n - j] |= symbols[j:]
    order = np.argsort(key)
    head = np.empty(n, np.int64)
    at = np.arange(n)

    def settle(at: np.ndarray, sorted_key: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes at places ``at`` of the order; gives the places still tied."""
        fresh = np.empty(len(at), bool)
        fresh[:1] = True
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=fresh[1:])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        head[order[at]] = at[first]
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        return at[~alone]

    at = settle(at, key[order])
    while len(at):
        tied = order[at]
        pair = head[tied] * n + head[tied + width]
        by = np.argsort(pair)
        order[at] = tied[by]
        at = settle(at, pair[by])
        width *= 2
    return order


class WaveletMatrix:
    """Rank and access over integers below ``n_symbols``, one bit plane per level."""

    def __init__(self, data: np.ndarray, n_symbols: int) -> None:
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        data = data.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (data >> level) & 1
            ones = np.zeros(len(data) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(data) - int(ones[-1]))
            up = bit.astype(bool)
            data = np.concatenate([data[~up], data[up]])
        # data is now grouped by symbol; where each symbol's group begins
        self.first = np.zeros(1 << self.levels, np.int64)
        if len(data):
            starts = np.flatnonzero(np.concatenate([[True], data[1:] != data[:-1]]))
            self.first[data[starts]] = starts

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each place."""
        place = at
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.ones[i][place]
            place = np.where((symbol >> level) & 1, self.zeros[i] + ones, place - ones)
        return np.where(at > 0, place - self.first[symbol], 0)

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol, place = np.zeros(len(at), np.int64), at
        for i in range(self.levels):
            ones = self.ones[i][place]
            bit = self.ones[i][place + 1] - ones
            symbol = symbol * 2 + bit
            place = np.where(bit, self.zeros[i] + ones, place - ones)
        return symbol, place - self.first[symbol]


class FMIndex:
    """Phrase search over the words of some documents."""

    def __init__(self, docs: list[list[bytes]]) -> None:
        n_docs = len(docs)
        self.vocabulary: dict[bytes, int] = {}
        sizes = np.array([len(d) for d in docs], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        n = int(self.starts[-1])
        text = np.zeros(n, np.int64)
        add = self.vocabulary.setdefault
        place = 0
        for words in docs:
            text[place : place + len(words)] = [add(w, len(self.vocabulary)) for w in words]
            place += len(words) + 1
        self.size = len(self.vocabulary)
        ends = self.starts[1:] - 1
        text += n_docs
        text[ends] = np.arange(n_docs)
        order = suffix_array(text, n_docs + self.size)
        text = np.maximum(text - n_docs + 1, 0)  # 0: any separator, words from 1
        self.before = WaveletMatrix(text[order - 1], self.size + 1)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size + 1))])
        sampled = np.zeros(n, bool)
        sampled[::SAMPLE] = True
        sampled[self.starts[:-1]] = True
        self.marked = sampled[order]
        self.marked_before = np.concatenate([[0], np.cumsum(self.marked)])
        self.samples = order[self.marked]
        self.rows = n

    def search(self, phrases: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of phrases, given as rows of ``length`` word ids from 0."""
        alive = np.arange(len(phrases))
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.rows, np.int64)
        for j in range(length - 1, -1, -1):
            c = phrases[alive, j] + 1
            low[alive] = self.smaller[c] + self.before.rank(c, low[alive])
            high[alive] = self.smaller[c] + self.before.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps back to a sampled position."""
        found = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows, 0
        while len(left):
            here = self.marked[at]
            found[left[here]] = self.samples[self.marked_before[at[here]]] + steps
            left, at = left[~here], at[~here]
            symbol, rank = self.before.access(at)
            at = self.smaller[symbol] + rank
            steps += 1
        return found


class Phrases:
    """Distinct phrases of a slice of the benchmark, by length, with their items."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int = WINDOW) -> None:
        known: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                known.setdefault(tuple(words[i : i + size]), set()).add(item)
        self.by_length: dict[int, list[tuple[tuple[bytes, ...], list[str]]]] = {}
        for phrase in sorted(known):
            self.by_length.setdefault(len(phrase), []).append((phrase, sorted(known[phrase])))

    def hits(self, docs: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int]], list[str]]]:
        """Per document the merged runs [from, to) of hit words and the items they belong to."""
        if not any(docs) or not self.by_length:
            for _ in docs:
                yield [], []
            return
        index = FMIndex(docs)
        change = np.zeros(index.rows + 1, np.int64)
        items: dict[int, set[str]] = {}
        for length, phrases in self.by_length.items():
            ids, owners = [], []
            for phrase, of in phrases:
                numbers = [index.vocabulary.get(w, -1) for w in phrase]
                if -1 not in numbers:
                    ids.append(numbers)
                    owners.append(of)
            if not ids:
                continue
            low, high = index.search(np.array(ids, np.int64), length)
            sizes = high - low
            which = np.repeat(np.arange(len(ids)), sizes)
            if not len(which):
                continue
            first = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            at = index.locate(first + np.arange(len(which)))
            np.add.at(change, at, 1)
            np.add.at(change, at + length, -1)
            doc = np.searchsorted(index.starts, at, "right") - 1
            for pair in np.unique(doc * len(ids) + which):
                items.setdefault(int(pair) // len(ids), set()).update(owners[int(pair) % len(ids)])
        hit = np.concatenate([[0], (np.cumsum(change)[:-1] > 0).view(np.int8), [0]])
        edge = np.diff(hit)
        begins, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        owner = np.searchsorted(index.starts, begins, "right") - 1
        runs: dict[int, list[tuple[int, int]]] = {}
        for d, b, e in zip(owner.tolist(), begins.tolist(), ends.tolist()):
            start = int(index.starts[d])
            runs.setdefault(d, []).append((b - start, e - start))
        for d in range(len(docs)):
            yield runs.get(d, []), sorted(items.get(d, ()))


def _shards(batches: Iterator[pa.RecordBatch], column: str):
    """Slices of batches with the words of their rows, about SHARD_WORDS at a time."""
    parts: list[pa.RecordBatch] = []
    docs: list[list[bytes]] = []
    size = 0
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        begin = 0
        for i, text in enumerate(texts):
            docs.append(words_of(text.as_py()))
            size += len(docs[-1]) + 1
            if size >= SHARD_WORDS:
                parts.append(batch.slice(begin, i + 1 - begin))
                yield parts, docs
                parts, docs, size, begin = [], [], 0, i + 1
        if begin < batch.num_rows:
            parts.append(batch.slice(begin))
    if parts:
        yield parts, docs


def _slices(benchmark: DataFrame) -> list[Phrases]:
    """The benchmark's phrases, at most about SLICE_WORDS words of text in each slice."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    letters = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = max(1, -(-int(letters) // (2 * SLICE_WORDS)))  # a word and a space: two letters at least
    made = []
    for i in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) if count > 1 else rows
        made.append(Phrases((r["item_id"], r["text"]) for r in part.collect()))
    return made


_RUN = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
_FOUND = [
    StructField("n_words", LongType()),
    StructField(
        "runs",
        ArrayType(StructType([StructField("from", LongType()), StructField("to", LongType())])),
    ),
    StructField("items", ArrayType(StringType())),
]


def _merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(runs):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _searched(
    rows: DataFrame, slices: Sequence[Phrases], store: Callable[[DataFrame], DataFrame], prefix: str = ""
) -> DataFrame:
    """``rows`` (of any columns, one of them text) with n_words, runs and items of all slices.

    ``store`` is applied between slices; ``prefix`` keeps the new columns' names apart.
    """
    width = len(rows.columns)
    schema = StructType([*rows.schema, *(StructField(prefix + f.name, f.dataType) for f in _FOUND)])
    found = rows
    for number, phrases in enumerate(slices):
        sent = rows.sparkSession.sparkContext.broadcast(phrases)

        def run(batches, sent=sent, number=number):
            for parts, texts in _shards(batches, "text"):
                hits = sent.value.hits(texts)
                at = 0
                for part in parts:
                    counts, runs, items = [], [], []
                    old = [([], [])] * part.num_rows
                    if number:
                        old = zip(*(part.column(width + i).to_pylist() for i in (1, 2)))
                    for old_runs, old_items in old:
                        new_runs, new_items = next(hits)
                        if number:
                            new_runs = _merged([*new_runs, *((r["from"], r["to"]) for r in old_runs)])
                            new_items = sorted({*new_items, *old_items})
                        counts.append(len(texts[at]))
                        runs.append([{"from": b, "to": e} for b, e in new_runs])
                        items.append(new_items)
                        at += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns[:width],
                            pa.array(counts, pa.int64()),
                            pa.array(runs, _RUN),
                            pa.array(items, pa.list_(pa.string())),
                        ],
                        names=schema.names,
                    )

        found = map_parts(store(found) if number else found, run, schema)
    return found


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text, n_words, runs of hit words [from, to), and items whose phrases occur."""
    return _searched(docs.select("doc_id", "text"), _slices(benchmark), lambda rows: rows)


def cut(text: str, runs: Iterable[tuple[int, int]]) -> str:
    """The text without its hit words; what stood between two hit words of a run goes too."""
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    out, last = [], 0
    for first, stop in runs:
        out.append(text[last : places[first][0]])
        last = places[stop - 1][1]
    return "".join([*out, text[last:]])


def _with(part: pa.RecordBatch, name: str, column: list) -> pa.RecordBatch:
    """The batch with another column of the same name and type."""
    at = part.schema.get_field_index(name)
    field = part.schema.field(at)
    return part.set_column(at, field, pa.array(column, field.type))


def _updated(part: pa.RecordBatch, new: list, changed: list[bool]) -> pa.RecordBatch:
    """The batch with new texts, and n_chars, if there, of the changed ones brought up to date."""
    part = _with(part, "text", new)
    if "n_chars" in part.schema.names:
        old_sizes = part.column(part.schema.get_field_index("n_chars")).to_pylist()
        part = _with(part, "n_chars", [len(t) if c else n for t, c, n in zip(new, changed, old_sizes)])
    return part


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with hit words cut out of ``text`` and n_chars, if there, brought up to date.

    Cutting can join words that then form a phrase again, so a hit document is
    searched until it is clean.  A document of which no word is left is dropped.
    With several slices a text is cut once all of them have searched it, and the hit
    documents are searched again by all, so the result is that of a single slice.
    """
    slices = _slices(benchmark)
    if len(slices) > 1:
        return _remove_by_passes(docs, slices)
    sent = docs.sparkSession.sparkContext.broadcast(slices[0])

    def run(batches):
        for parts, texts in _shards(batches, "text"):
            hits = sent.value.hits(texts)
            for part in parts:
                column = part.schema.get_field_index("text")
                keep, new, changed = [], [], []
                for old in part.column(column).to_pylist():
                    runs, _ = next(hits)
                    changed.append(bool(runs))
                    while runs:
                        old = cut(old, runs)
                        runs, _ = next(sent.value.hits([words_of(old)]))
                    new.append(old)
                    keep.append(not changed[-1] or bool(words_of(old)))
                if any(changed):
                    part = _updated(part, new, changed)
                yield part.filter(pa.array(keep, pa.bool_()))

    return map_parts(docs, run, docs.schema)


def _remove_by_passes(docs: DataFrame, slices: Sequence[Phrases]) -> DataFrame:
    columns = docs.columns
    mark = "_".join(["hit", *columns])  # no column's name
    schema = StructType([*docs.schema, StructField(mark, BooleanType())])

    def run(batches):
        for part in batches:
            runs = [[(r["from"], r["to"]) for r in row] for row in part.column(len(columns) + 1).to_pylist()]
            hit = [bool(r) for r in runs]
            part = part.select(list(range(len(columns))))
            keep = [True] * part.num_rows
            if any(hit):
                old = part.column(part.schema.get_field_index("text")).to_pylist()
                new = [cut(t, r) if r else t for t, r in zip(old, runs)]
                part = _updated(part, new, hit)
                keep = [not h or bool(words_of(t)) for h, t in zip(hit, new)]
            part = part.append_column(mark, pa.array(hit, pa.bool_()))
            yield part.filter(pa.array(keep, pa.bool_()))

    with Workspace(docs.sparkSession, "decontaminate") as space:
        done, left = [], docs
        while True:
            passed = space.step(map_parts(_searched(left, slices, space.step, mark), run, schema))
            done.append(passed.where(~F.col(mark)).select(*columns))
            left = passed.where(F.col(mark)).select(*columns)
            if left.isEmpty():
                break
        clean = done[0]
        for more in done[1:]:
            clean = clean.unionAll(more)
        return space.keep(clean)
