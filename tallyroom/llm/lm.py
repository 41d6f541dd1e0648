"""Hidden Markov language model: Baum-Welch over Spark partitions, exact scoring.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, and one
end token.  A first pass turns the documents into blocks of about ``BLOCK_CHARS``
characters with word numbers of their own, and stores them.  A block's words are dealt
to buckets by a hash of the word, packed, one row a (block, bucket); a bucket counts its
words and gives every block the counts and the words' ranks in the bucket back.  So the
vocabulary may be of any size, and no task and not the driver holds it.

The model: hidden states with transitions; every word seen in training has expected
counts of its own in each state, whatever its frequency.  Words share classes by a hash
of their first bytes, which start the training and smooth it.  With E the expected counts
in state k, C a word's count, n and t the tokens and types of its class,

    P(word | k) = P(class | k) * (n / (n + t) * E(word) / E(class) + t / (n + t) * (C + 1) / (n + t))

The end token and unknown words have classes of their own; that of unknown words has the
base model's probability of one in each state.  The probabilities of all words, the end
and the unknown one sum to one in every state.

A Baum-Welch round scans the blocks, runs the scaled forward-backward recursion over all
training documents, and sends each bucket the expected counts of its words, in whole
multiples of ``1 / UNIT`` and packed; the bucket adds them up by rank while they stream
by and gives every block the sums of its words back.  Sums of classes take two steps.
The recursion runs over pieces of ``PIECE`` tokens side by side.  A piece reads ``WARM``
tokens on both sides of it as well, whose states are not counted, so every token and
every transition counts once, and with its surroundings on both sides.  Scores come from
one scaled forward recursion over each whole document, from its first word to its end.

Defined results: NULL and empty texts are the end token alone; NULL ids are
scored like others (and train, as fold 0); repeated rows count and are scored
once each; without training rows every token is unknown and scores zero but for rounding;
other columns of any name are not read and do not come back.
"""

from __future__ import annotations

import gc
from collections import defaultdict
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace, map_parts

BLOCK_CHARS = 4_000_000
STATES = 8
ROUNDS = 5
PIECE, WARM = 512, 32
CLASSES = 1 << 13
#: Bytes of a word that choose its class.
STEM = 4
#: Pseudo-counts: of the class distribution in each state, of transitions.
PRIOR_MASS, PRIOR_STEP = 50.0, 1.0
#: Expected counts are whole multiples of a part of one.
UNIT = 1 << 10
#: (word, block) pairs that a bucket has, about; and buckets at least.
BUCKET_ROWS = 1 << 19
MIN_BUCKETS = 8
#: Blocks that a part of the stored blocks has, about; and parts at most.
PART_BLOCKS, MAX_PARTS = 4, 50_000
_SLICE = 4096
#: Tokens whose states are summed, and whose scales are kept, at a time.
_STRETCH, _SCALES = 8192, 1 << 17
_SALTS = 16

#: Classes of the end and of unknown words; those of words follow.
_END, _UNKNOWN, _FIRST = 0, 1, 2
#: Kinds of rows: the words of a block in a bucket; sums of classes are their slice, or this.
_WORDS, _REST = -2, -1


_KINDS = (np.int8, np.int16, np.int32, np.int64)


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in the narrowest kind that holds them, byte by byte in planes."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    kind = next(k for k in _KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    planes = np.ascontiguousarray(numbers, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return bytes([np.dtype(kind).itemsize]) + zstandard.compress(np.ascontiguousarray(planes.T), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    numbers = np.empty(planes.shape[1], _KINDS[data[0].bit_length() - 1])
    there = numbers.view(np.uint8).reshape(-1, data[0])
    for i, plane in enumerate(planes):  # numpy copies a column faster than it transposes
        there[:, i] = plane
    return numbers


def _rows(made: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [part.split() for part in ddl.split(", ")]
    columns = list(zip(*made)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[name for name, _ in fields]
    )


_TYPES = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "array<boolean>": pa.list_(pa.bool_()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
}
_BLOCK_DDL = (
    "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, ids binary, "
    "n_words long, vocab binary, counts binary"
)


def words_of(texts: pa.StringArray) -> tuple[np.ndarray, pa.StringArray]:
    """The number of words of each text, and all words, A-Z lower-cased."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # blanks are 0x20 and 0x09-0x0D
    words = lists.flatten()
    there = pc.not_equal(pc.binary_length(words), 0)  # blanks at the ends leave empty ones
    ends = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return np.diff(ends[offsets - offsets[0]]), words.filter(there)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    doc_ids, held, sizes, words = [], [], [], []
    chars = 0

    def flush() -> pa.RecordBatch:
        coded = pa.concat_arrays(words).dictionary_encode()
        flat, vocab = coded.indices.to_numpy(), coded.dictionary
        trains = np.repeat(~np.concatenate(held), np.concatenate(sizes))
        counts = np.bincount(flat[trains], minlength=len(vocab))
        # No word has a blank.
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(vocab)], pa.int32()), vocab), " ")
        listed = zstandard.compress(joined[0].as_buffer(), 1)
        row = (
            (task << 32) + number, [i for d in doc_ids for i in d], np.concatenate(held), np.concatenate(sizes),
            _pack(flat), len(vocab), listed, _pack(counts),
        )
        return _rows([row], _BLOCK_DDL)

    for batch in batches:
        n, found = words_of(batch.column(1).cast(pa.string()).fill_null(""))
        doc_ids.append(batch.column(0).to_pylist())
        held.append(batch.column(2).to_numpy(zero_copy_only=False))
        sizes.append(n)
        words.append(found)
        chars += batch.nbytes
        if chars >= BLOCK_CHARS:
            yield flush()
            number += 1
            doc_ids, held, sizes, words, chars = [], [], [], [], 0
    if doc_ids:
        yield flush()


def _listed(vocab: bytes) -> list[bytes]:
    return zstandard.decompress(vocab).split()


def _as_array(words: bytes) -> pa.LargeBinaryArray:
    """The packed words, none of which is empty or has a blank, without an object for each."""
    data = zstandard.decompress(words)
    ends = pa.py_buffer(np.array([0, len(data)], np.int64))
    whole = pa.LargeStringArray.from_buffers(1, ends, pa.py_buffer(data))
    return pc.ascii_split_whitespace(whole).flatten().cast(pa.large_binary())


_DEALT_DDL = "bucket int, block long, places binary, words binary, counts binary"


def _deal(buckets: int):
    """The words of each block by bucket, with their places and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, vocab, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words, counts = _listed(vocab), _unpack(counts)
                to = np.fromiter(map(crc32, words), np.uint32, len(words)) % np.uint32(buckets)
                by = np.argsort(to, kind="stable")
                words = [words[i] for i in by.tolist()]
                edge = np.flatnonzero(np.diff(to[by].astype(np.int64), prepend=-1, append=-1))
                yield _rows(
                    [
                        (
                            int(to[by[a]]), block, _pack(by[a:b]),
                            zstandard.compress(b" ".join(words[a:b]), 1), _pack(counts[by[a:b]]),
                        )
                        for a, b in zip(edge, edge[1:])
                    ],
                    _DEALT_DDL,
                )

    return run


_COUNTED_DDL = "block long, bucket int, places binary, ranks binary, c binary, classes binary, tokens array<long>, types array<long>"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the words of each bucket over all blocks; what each block asked for, and sums by class."""
    read, asked = defaultdict(list), defaultdict(list)
    for batch in batches:
        for bucket, block, places, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            read[bucket].append(_as_array(words))
            asked[bucket].append((block, places, counts))
    tokens, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for bucket in list(read):
        coded = pa.chunked_array(read.pop(bucket)).dictionary_encode()
        words, at = coded.chunk(0).dictionary, [c.indices.to_numpy() for c in coded.chunks]
        total = np.zeros(len(words), np.int64)
        for here, (_, _, counts) in zip(at, asked[bucket]):
            total[here] += _unpack(counts)
        # Ranks in the order of the words, so a task that runs again gives the same ones.
        ranks = np.empty(len(words), np.int32)
        ranks[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        stems = pc.binary_slice(words, 0, STEM).dictionary_encode()
        hashes = np.fromiter(map(crc32, stems.dictionary.to_pylist()), np.uint32, len(stems.dictionary))
        classes = (hashes % np.uint32(CLASSES)).astype(np.int32)[stems.indices.to_numpy()]
        tokens += np.bincount(classes, total, CLASSES).astype(np.int64)
        types += np.bincount(classes[total > 0], minlength=CLASSES)
        kinds = np.where(total > 0, classes + _FIRST, _UNKNOWN).astype(np.int32)
        rows = list(zip(at, asked.pop(bucket)))
        for i in range(0, len(rows), 64):
            yield _rows(
                [
                    (block, bucket, places, _pack(ranks[here]), _pack(total[here]), _pack(kinds[here]), None, None)
                    for here, (block, places, _) in rows[i : i + 64]
                ],
                _COUNTED_DDL,
            )
    if types.any():
        yield _rows([(None, None, None, None, None, None, tokens.tolist(), types.tolist())], _COUNTED_DDL)


@dataclass
class Model:
    start: np.ndarray  # distribution of a document's first state
    again: np.ndarray  # distribution of the state where a later piece begins to read
    step: np.ndarray
    emit: np.ndarray  # classes x states, float32
    sums: np.ndarray | None = None  # expected counts of the classes, of the round that made the words'
    tokens: np.ndarray | None = None  # of each class
    types: np.ndarray | None = None


def _first_model(counts: np.ndarray, unknown: float, states: int) -> Model:
    """States that differ by seeded noise; words add their own in the first round."""
    noise = np.exp(np.random.default_rng(0).normal(0, 1.0, (len(counts), states)))
    step = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    flat = np.full(states, 1 / states)
    return Model(flat, flat, step, _emission(counts, unknown, counts[:, None] * noise))


def _noise(buckets: np.ndarray, ranks: np.ndarray, states: int) -> np.ndarray:
    """Factors from 1/e to e for each word and state, mixed from the word's bucket and rank."""
    words = (np.asarray(buckets, np.uint64) << np.uint64(32)) + np.asarray(ranks, np.uint64)
    mixed = words[:, None] * np.uint64(states) + np.arange(states, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.exp((mixed >> np.uint64(11)) / 2.0**52 - 1)


def _emission(counts: np.ndarray, unknown: float, expected: np.ndarray) -> np.ndarray:
    """Class probabilities per state, smoothed by the corpus, beside the unknown class."""
    corpus = (counts / max(1, counts.sum()))[:, None]
    sums = expected.sum(axis=0) + PRIOR_MASS
    emit = (expected + PRIOR_MASS * corpus) / sums * (1 - unknown)
    emit[_UNKNOWN] = unknown
    return emit.astype(np.float32)


def forward(model: Model, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each class sequence flat[start : start + size], all sizes at least 1.

    All sequences advance together, longest first, so memory is one state vector each.
    """
    by = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by], sizes[by]
    running = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
    step, one = model.step.astype(np.float32), np.ones(len(model.start), np.float32)
    total = np.zeros(len(sizes))
    scales, held = np.empty(max(_SCALES, len(sizes)), np.float32), []

    def add_up() -> None:
        edge = np.cumsum(held)
        logs = np.log10(scales[: edge[-1]], dtype=np.float64)
        # In the order of the steps for each sequence; those of a later step are the first ones.
        at = np.arange(edge[-1]) - np.repeat(edge - held, held)
        np.add.at(total, at, logs)
        held.clear()

    end = 0
    state = np.broadcast_to(model.start.astype(np.float32), (len(sizes), len(model.start)))
    ahead, now, seen = (np.empty(state.shape, np.float32) for _ in range(3))
    for t, n in enumerate(running.tolist()):
        state = np.matmul(state[:n], step, out=ahead[:n]) if t else state[:n]
        there = model.emit.take(flat.take(starts[:n] + t), axis=0, out=seen[:n], mode="clip")
        state = np.multiply(state, there, out=now[:n])
        if end + n > len(scales):
            add_up()
            end = 0
        scale = np.matmul(state, one, out=scales[end : end + n])
        held.append(n)
        end += n
        state *= (1 / scale)[:, None]
    if held:
        add_up()
    out = np.empty(len(sizes))
    out[by] = total
    return out


@dataclass
class Pieces:
    """Stretches of sequences that are read from ``start`` on; the tokens [begin, end) of them count."""

    start: np.ndarray
    size: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, starts: np.ndarray, sizes: np.ndarray, piece: int = PIECE, warm: int = WARM) -> Pieces:
        n = -(-sizes // piece)
        index = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        first, last = np.repeat(starts, n), np.repeat(starts + sizes, n)
        low = first + index * piece
        high = np.minimum(low + piece, last)
        start = np.maximum(first, low - warm)
        return cls(start, np.minimum(high + warm, last) - start, low - start, high - start)

    def longest_first(self) -> Pieces:
        by = np.argsort(-self.size, kind="stable")
        return Pieces(self.start[by], self.size[by], self.begin[by], self.end[by])


def expectations(
    model: Model, flat: np.ndarray, pieces: Pieces
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected emissions (classes x states), transitions, first states of documents and of later pieces.

    A piece that counts from its first token on opens a document.
    """
    states = len(model.start)
    pieces = pieces.longest_first()
    opens = pieces.begin == 0
    running = np.searchsorted(-pieces.size, -np.arange(int(pieces.size[0])), "left").tolist()
    step, one = model.step.astype(np.float32), np.ones(states, np.float32)
    back = np.ascontiguousarray(step.T)
    # By time: the classes seen, and the state probabilities, first of the past, then of all.
    edge = np.concatenate([[0], np.cumsum(running)]).tolist()
    classes = np.empty(edge[-1], np.intp)
    gamma = np.empty((edge[-1], states), np.float32)
    scales = np.empty((edge[-1], 1), np.float32)
    # Steps write where an earlier one did, so no memory is asked for and touched anew.
    ahead, other, seen = (np.empty((running[0], states), np.float32) for _ in range(3))
    state = np.where(opens[:, None], model.start, model.again).astype(np.float32)
    for t, n in enumerate(running):
        now = slice(edge[t], edge[t + 1])
        classes[now] = flat.take(pieces.start[:n] + t)
        state = np.matmul(state[:n], step, out=ahead[:n]) if t else state[:n]
        there = model.emit.take(classes[now], axis=0, out=seen[:n], mode="clip")
        state = np.multiply(state, there, out=gamma[now])
        np.divide(1, state @ one, out=scales[now, 0])
        state *= scales[now]
    moves, later = np.zeros((states, states)), np.zeros(states)
    beta = np.empty((0, states), np.float32)
    # Steps between these have no token that does not count.
    early, late = pieces.begin.max(), pieces.end[pieces.end < pieces.size].min(initial=len(running))
    later_at = set(pieces.begin.tolist()) - {0}
    outside = none = np.empty(0, np.int64)
    for t in range(len(running) - 1, -1, -1):
        n, m = running[t], len(beta)
        now = gamma[edge[t] : edge[t] + n]
        here = (ahead, other)[t % 2][:n]
        here[m:] = 1
        if m:
            after = slice(edge[t + 1], edge[t + 1] + m)
            beta *= model.emit.take(classes[after], axis=0, out=seen[:m], mode="clip")
            beta *= scales[after]
            # A transition counts with the token that it leads to.
            moves += now[:m].T @ beta
            if len(outside):
                moves -= now[outside].T @ beta[outside]
                gamma[after][outside] = 0
            np.matmul(beta, back, out=here[:m])
            now *= here
        beta = here
        outside = none
        if t < early or t >= late:
            outside = np.flatnonzero((pieces.begin[:n] > t) | (pieces.end[:n] <= t))
        if t in later_at:
            later += now[pieces.begin[:n] == t].sum(axis=0)
    opened = gamma[: edge[1]][opens].sum(axis=0)
    gamma[outside] = 0
    moves *= model.step
    return _by_class(classes, gamma, len(model.emit)), moves, opened, later


def _by_class(classes: np.ndarray, gamma: np.ndarray, n: int) -> np.ndarray:
    """Sums the rows of each class, in stretches: a class's states are side by side, and so are a token's.

    Two states are added at once, as the parts of a complex number, where their number is even.
    """
    states = gamma.shape[1]
    one, sums = (np.complex64, np.complex128) if states % 2 == 0 else (np.float32, np.float64)
    rows = gamma.view(one)
    emitted, every = np.zeros(n * rows.shape[1], sums), np.arange(rows.shape[1])
    for i in range(0, len(classes), _STRETCH):
        at = (classes[i : i + _STRETCH, None] * rows.shape[1] + every).ravel()
        np.add.at(emitted, at, rows[i : i + _STRETCH].ravel().astype(sums))
    return emitted.view(np.float64).reshape(-1, states)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums arrays by slice while they stream by."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, data in zip(*(c.to_pylist() for c in batch.columns)):
            array = np.frombuffer(data, np.int64)
            sums[part] = sums[part] + array if part in sums else array
    if sums:
        yield _rows([(part, array.tobytes()) for part, array in sums.items()], "part int, data binary")


@dataclass
class Block:
    """A block's documents as sequences of places in its own list of words, the end last."""

    number: int
    held: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray
    kinds: np.ndarray  # classes of the words, then that of the end
    c: np.ndarray  # counts of the words
    known: np.ndarray  # places of the words seen in training, by bucket and rank
    buckets: np.ndarray  # of each of those
    ranks: np.ndarray  # of each of those, in its bucket the same for all blocks
    counts: np.ndarray | None  # of each of those, units expected in each state over all blocks

    def model(self, model: Model) -> Model:
        """The model with a row for each place; the first round's words differ by noise."""
        emit = model.emit.take(self.kinds, axis=0)
        kinds, c = self.kinds[self.known], self.c[self.known]
        n, t = model.tokens[kinds], model.types[kinds]
        share = ((c + 1) / (n + t)).astype(np.float32)[:, None]
        if self.counts is not None:
            # A class that is never in a state says nothing of its words there.
            spare = (t / (n + t)).astype(np.float32)[:, None]
            own = np.maximum(model.sums, 1).astype(np.float32).take(kinds, axis=0)
            np.divide(self.counts, own, out=own)
            own *= 1 - spare
            own += spare * share
            share = np.where((model.sums > 0).take(kinds, axis=0), own, share)
        elif model.sums is None:
            share = share * _noise(self.buckets, self.ranks, len(model.start))
        own = model.emit.take(kinds, axis=0)
        own *= share.astype(np.float32, copy=False)
        emit[self.known] = own
        return Model(model.start, model.again, model.step, emit)


def _blocks(batches: Iterator[pa.RecordBatch], states: int) -> Iterator[Block]:
    """The blocks of rows (block, held, sizes, flat, kinds, c, known, buckets, ranks, states ...)."""
    for batch in batches:
        for number, held, sizes, flat, kinds, c, known, buckets, ranks, sums in zip(
            *(batch.column(i) for i in range(10))
        ):
            known, counts = _unpack(known.as_py()), None
            if sums.is_valid:
                counts, at = np.empty((len(known), states), np.float32), 0
                for part in sums.values.field("data"):
                    part = _unpack(part.as_py()).reshape(states, -1).T
                    counts[at : at + len(part)] = part
                    at += len(part)
            yield Block(
                number.as_py(),
                held.values.to_numpy(zero_copy_only=False),
                sizes.values.to_numpy().astype(np.int64),
                _unpack(flat.as_py()),
                _unpack(kinds.as_py()),
                _unpack(c.as_py()),
                known,
                _unpack(buckets.as_py()).astype(np.int64),
                np.cumsum(_unpack(ranks.as_py()), dtype=np.int64),
                counts,
            )


def _with_states(coded: DataFrame, states: DataFrame | None, parts: int) -> DataFrame:
    """Blocks with the words' expected counts, by bucket; NULL without any."""
    head, rest = coded.columns[:9], coded.columns[9:]
    if states is None:
        return coded.select(*head, F.lit(None).cast(_STATES_TYPE).alias("states"), *rest)
    by_block = states.repartition(parts, "block").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "data"))).alias("states")  # the words of a block
    )
    return coded.join(by_block, "block", "left").select(*head, "states", *rest)


_STATES_TYPE = "array<struct<bucket: int, data: binary>>"


_SENT_DDL = "part int, data binary, block long, bucket int, ranks binary"
_SUMMED_DDL = "part int, block long, bucket int, data binary"


def _sum_words(states: int):
    """Sums the rows of each bucket by rank and gives every block its own back; sums the class rows by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[int, int, bytes]] = []
        totals: dict[int, np.ndarray] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data, block, bucket, ranks in zip(*(batch.column(i) for i in range(5))):
                part, data, bucket = part.as_py(), data.as_py(), bucket.as_py()
                if part != _WORDS:
                    array = np.frombuffer(data, np.int64)
                    sums[part] = sums[part] + array if part in sums else array
                    continue
                at = np.cumsum(_unpack(ranks.as_py()), dtype=np.int64)
                total = totals.get(bucket, np.zeros((0, states), np.int64))
                if len(total) <= at[-1]:
                    total = np.concatenate([total, np.zeros((int(at[-1]) + 1 - len(total) + len(total) // 2, states), np.int64)])
                total[at] += _unpack(data).reshape(states, -1).T
                totals[bucket] = total
                asked.append((block.as_py(), bucket, ranks.as_py()))
        if sums:
            yield _rows([(part, None, None, array.tobytes()) for part, array in sums.items()], _SUMMED_DDL)
        for i in range(0, len(asked), 64):
            yield _rows(
                [
                    (_WORDS, block, bucket, _pack(totals[bucket][np.cumsum(_unpack(ranks), dtype=np.int64)].T))
                    for block, bucket, ranks in asked[i : i + 64]
                ],
                _SUMMED_DDL,
            )

    return run


def _whole(numbers: np.ndarray) -> np.ndarray:
    return np.rint(numbers * UNIT).astype(np.int64)


def _round(
    coded: DataFrame, model: Model, states_of: DataFrame | None, counts: np.ndarray, unknown: float,
    parts: int, buckets: int, space: Workspace,
) -> tuple[Model, DataFrame]:
    """One Baum-Welch round over all training documents: the model and the words' counts."""
    sent = coded.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        emitted = np.zeros((len(own.emit), states), np.int64)
        rest = np.zeros((states + 2, states), np.int64)
        for block in _blocks(batches, states):
            here = np.zeros((len(block.kinds), states), np.int64)
            trains = ~block.held
            if trains.any():
                starts = np.cumsum(block.sizes) - block.sizes
                here, moves, opened, later = map(_whole, expectations(
                    block.model(own), block.flat, Pieces.of(starts[trains], block.sizes[trains])
                ))
                for k in range(states):
                    emitted[:, k] += np.bincount(block.kinds, here[:, k], len(emitted)).astype(np.int64)
                rest += np.concatenate([moves, [opened], [later]])
            # Blocks without training rows ask for the counts of their words, too.
            words = here.take(block.known, axis=0)
            if words.max(initial=0) <= np.iinfo(np.int32).max:
                words = words.astype(np.int32)
            edge = np.flatnonzero(np.diff(block.buckets, prepend=-1, append=-1))
            yield _rows(
                [
                    (
                        _WORDS, _pack(words[a:b].T), block.number, int(block.buckets[a]),
                        _pack(np.diff(block.ranks[a:b], prepend=0)),
                    )
                    for a, b in zip(edge, edge[1:])
                ],
                _SENT_DDL,
            )
        parts = [(_REST, rest.tobytes())]
        parts += [
            (i, emitted[i * _SLICE : (i + 1) * _SLICE].tobytes()) for i in range(-(-len(emitted) // _SLICE))
        ]
        # The classes go to buckets under zero, by part and salt.
        salt = TaskContext.get().partitionId() % _SALTS
        yield _rows([(i, data, None, -1 - (i + 1) * _SALTS - salt, None) for i, data in parts], _SENT_DDL)

    made = space.step(
        _with_states(coded, states_of, parts)
        .mapInArrow(run, _SENT_DDL)
        .repartition(buckets, "bucket")
        .mapInArrow(_sum_words(states), _SUMMED_DDL)
    )
    summed = (
        made.where(F.col("part") != _WORDS)
        .select("part", "data")
        .repartition("part")
        .mapInArrow(_sum_rows, "part int, data binary")
        .collect()  # the model's size
    )
    arrays = {r["part"]: np.frombuffer(r["data"], np.int64).reshape(-1, states) for r in summed}
    rest = arrays.pop(_REST) / UNIT
    expected = np.concatenate([arrays[i] for i in sorted(arrays)])
    of_words = made.where(F.col("part") == _WORDS).select("block", "bucket", "data")
    moves, opened, later = rest[:states] + PRIOR_STEP, rest[states] + 1, rest[states + 1] + 1
    return Model(
        opened / opened.sum(), later / later.sum(), moves / moves.sum(axis=1, keepdims=True),
        _emission(counts, unknown, expected / UNIT), expected, model.tokens, model.types,
    ), of_words


def _bucketed(df: DataFrame, parts: int, space: Workspace) -> DataFrame:
    """A stored step that joins by block without an exchange of its own.

    The table is external and forgotten at once; its files go with the workspace.
    """
    name, path = f"tallyroom_{uuid4().hex}", f"{space.base}/steps/bucketed"
    writer = df.write.format("parquet").option("compression", "uncompressed").option("path", path)
    writer.bucketBy(parts, "block").sortBy("block").saveAsTable(name)
    table = df.sparkSession.read.table(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
    return table


def _release(space: Workspace) -> None:
    """Lets Spark remove the shuffle files of what is done; it does so when the driver collects garbage."""
    gc.collect()
    space.spark.sparkContext._jvm.System.gc()


@dataclass
class Fitted:
    """The documents as word sequences, with the model that was trained on them."""

    coded: DataFrame
    n_tokens: int
    model: Model
    states: DataFrame | None  # of the words of a block, expected counts in each state
    parts: int  # that the blocks are stored in


def fit(
    docs: DataFrame, held: Column, space: Workspace, states: int = STATES, rounds: int = ROUNDS
) -> Fitted:
    """Counts and trains on the rows of ``docs`` (doc_id, text) for which ``held`` is false."""
    # The blocks' words and their counts go when the coded blocks are stored.
    with Workspace(space.spark, "lm-words") as early:
        blocks = early.step(
            map_parts(
                docs.select(F.col("doc_id").cast("long"), "text", held.alias("held")), _block_rows, _BLOCK_DDL
            )
        )
        trains = F.filter(F.arrays_zip("held", "sizes"), lambda d: ~d["held"])
        size = blocks.select(
            F.size(trains).cast("long").alias("ends"),
            F.aggregate(trains, F.lit(0).cast("long"), lambda n, d: n + d["sizes"]).alias("words"),
            "n_words",
            F.lit(1).alias("blocks"),
        ).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("ends", "words", "n_words", "blocks")]).first()
        n_ends, n_tokens = int(size["ends"]), int(size["ends"]) + int(size["words"])
        parts = min(MAX_PARTS, 1 + int(size["blocks"]) // PART_BLOCKS)
        buckets = max(MIN_BUCKETS, -(-int(size["n_words"]) // BUCKET_ROWS))
        counted = early.step(
            blocks.select("block", "vocab", "counts")
            .mapInArrow(_deal(buckets), _DEALT_DDL)
            .repartition(buckets, "bucket")
            .mapInArrow(_count, _COUNTED_DDL)
        )
        _release(space)
        by_class = (
            counted.where(F.col("types").isNotNull())
            .select(F.posexplode(F.arrays_zip("tokens", "types")).alias("class", "n"))
            .groupBy("class")
            .agg(F.sum("n.tokens").alias("tokens"), F.sum("n.types").alias("types"))
            .collect()  # CLASSES rows at most
        )
        tokens, types = np.zeros(_FIRST + CLASSES, np.int64), np.zeros(_FIRST + CLASSES, np.int64)
        tokens[_END], types[_END] = n_ends, n_ends > 0
        for row in by_class:
            tokens[_FIRST + row["class"]], types[_FIRST + row["class"]] = row["tokens"], row["types"]
        n_types = int(types.sum())
        by_block = (
            counted.where(F.col("types").isNull())
            .repartition(parts, "block")
            .groupBy("block")
            .agg(F.sort_array(F.collect_list(F.struct("bucket", "places", "ranks", "c", "classes"))).alias("words"))
        )  # the words of a block, packed
        coded = _bucketed(
            blocks.select("block", "doc_ids", "held", "sizes", "ids")
            .repartition(parts, "block")
            .join(by_block, "block", "left")
            .select("block", "doc_ids", "held", "sizes", "ids", "words")
            .mapInArrow(_coder(n_tokens, n_types, n_ends), _CODED_DDL),
            parts,
            space,
        )
    _release(space)
    unknown = 1 / (n_tokens + n_types + 1)
    model = _first_model(tokens, unknown, states)
    model.tokens, model.types = tokens, types
    of_words = None
    if n_ends:
        # What a round stores goes when the next one is done, but for the last one's counts.
        with ExitStack() as before:
            for i in range(rounds):
                with ExitStack() as own:
                    last = i + 1 == rounds
                    work = space if last else own.enter_context(Workspace(space.spark, "lm-round"))
                    model, of_words = _round(coded, model, of_words, tokens, unknown, parts, buckets, work)
                    before.close()
                    before.push(own.pop_all())
                _release(space)
    return Fitted(coded, n_tokens, model, of_words, parts)


_CODED_DDL = (
    "block long, held array<boolean>, sizes array<int>, flat binary, kinds binary, c binary, "
    "known binary, buckets binary, ranks binary, doc_ids array<long>, n_known array<long>, base array<double>"
)


def _coder(n_tokens: int, n_types: int, n_ends: int):
    """Blocks as sequences of places, each document with its end, with what is known of the words."""
    floor = n_tokens + n_types + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, doc_ids, held, sizes, ids, words in zip(*batch.columns):
                sizes = sizes.values.to_numpy().astype(np.int64)
                ids = _unpack(ids.as_py())
                parts = words.as_py() or []
                place, ranks, kinds = (
                    np.concatenate([_unpack(p[f]) for p in parts] or [np.zeros(0, np.int32)])
                    for f in ("places", "ranks", "classes")
                )
                c = np.concatenate([_unpack(p["c"]) for p in parts] or [np.zeros(0, np.int64)])
                bucket = np.repeat([p["bucket"] for p in parts], [len(_unpack(p["places"])) for p in parts]).astype(np.int64)
                seen = np.flatnonzero(c > 0)
                seen = seen[np.lexsort((ranks[seen], bucket[seen]))]
                # Ranks as steps; in a new bucket the step starts the ranks again.
                steps = np.diff(ranks[seen].astype(np.int64), prepend=0)
                # Places anew, the most frequent words first, so numbers are small.
                by = np.argsort(-c, kind="stable")
                fresh = np.empty(len(c), np.int64)
                fresh[place[by]] = np.arange(len(c))
                of_old = np.empty(len(c), np.int64)
                of_old[by] = np.arange(len(c))
                ids, kinds_at, c_at = fresh[ids], kinds[by], c[by]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                flat = np.full(len(ids) + len(sizes), len(c), np.int32)
                is_word = np.ones(len(flat), bool)
                is_word[np.cumsum(sizes + 1) - 1] = False
                flat[is_word] = ids
                base = np.bincount(doc, np.log10((c_at + 1) / floor)[ids], len(sizes))
                n_known = np.bincount(doc, (c_at > 0)[ids], len(sizes)).astype(np.int64)
                row = (
                    block.as_py(), held.as_py(), sizes + 1, _pack(flat),
                    _pack(np.append(kinds_at, _END if n_ends else _UNKNOWN)), _pack(c_at),
                    _pack(of_old[seen]), _pack(bucket[seen]), _pack(steps), doc_ids.as_py(),
                    n_known + (n_ends > 0), base + np.log10((n_ends + 1) / floor),
                )
                yield _rows([row], _CODED_DDL)

    return run


def score(fitted: Fitted) -> DataFrame:
    """Per document: held_out, token counts, base score and the model's log10 probability."""
    sent = fitted.coded.sparkSession.sparkContext.broadcast(fitted.model)
    n_tokens = fitted.n_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = list(zip(*(batch.column(i) for i in range(10, 13))))
            for i, block in enumerate(_blocks(iter([batch]), len(sent.value.start))):
                doc_ids, known, base = (x.values for x in rest[i])
                sizes = block.sizes
                chain = forward(block.model(sent.value), block.flat, np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids, pa.array(block.held), pa.array(sizes), known,
                        pa.array(np.full(len(sizes), n_tokens)), base, pa.array(chain),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return _with_states(fitted.coded, fitted.states, fitted.parts).mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
