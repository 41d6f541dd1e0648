"""Language identification by prediction by partial matching.

One byte context tree a language: the counts of every byte after every context of up to
``ORDER`` bytes in the language's texts.  A text is as likely in a language as its code
is short there.  A byte is coded after the longest context that the tree has; a context
seen n times with t different bytes gives a byte seen c times c / (n + t) and escapes
with t / (n + t).  After an escape the next shorter context is asked, without the bytes
that the longer one knows (they are excluded from its n and t); below the empty context
all bytes that are left are equally likely.  Statistics are frozen after learning, so a
byte's code length depends on it and the ``ORDER`` bytes before it alone.  The first
bytes of a text have blank lines before them.

Code lengths are whole multiples of 2**-16 bits, so sums do not depend on how texts are
spread over tasks or cut there: every byte of every text counts.

Learning: at most ``FIT_ROWS`` rows a language, whole texts, picked by a hash of id and
text and then by rank, so the bound holds whatever repeats; of more than MAX_LANGUAGES
different values of ``lang`` the most frequent ones are learned.  The trees (counts of the
sampled texts' bytes) are what is sent to all tasks.  Scoring covers all rows.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as all
are if nothing could be learned; rows without a language, an id or a text may be among
the rows to learn from (no text teaches nothing); of equally short codes the first
language in order wins; repeated rows give the same row each; other columns of any name
are not read and do not come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroom.llm.common import map_parts, values

ORDER = 4
FIT_ROWS = 1500
MAX_LANGUAGES = 1024
UNKNOWN = "und"
#: Units of a bit that code lengths are counted in.
UNIT = 1 << 16
#: Positions that are looked up at a time, for one language.
_CHUNK = 1 << 21
#: Code lengths that a task remembers.
_SLOTS = 1 << 19
_PICK = 1 << 30


def _units(bits: np.ndarray) -> np.ndarray:
    return np.rint(bits * UNIT).astype(np.int32)


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << (8 * n)) - 1)


@dataclass
class Level:
    """The contexts of one length, and the bytes seen after them."""

    contexts: np.ndarray  # sorted
    coded: np.ndarray  # units of log2(n + t)
    escape: np.ndarray  # units of an escape if the context is the longest one
    rest: np.ndarray  # units of log2(n + t) in the next shorter context, without the bytes known here
    leave: np.ndarray  # units of an escape from there; 0 with ``rest`` where no byte is left
    pairs: np.ndarray  # context and byte, sorted
    seen: np.ndarray  # units of log2(c)


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each is, and whether it is there."""
    if not len(known):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


class Tree:
    """The context tree of one language, from the counts of (ORDER + 1)-byte strings."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int) -> None:
        self.levels: list[Level] = []
        shorter = None
        for k in range(order + 1):
            pairs, which = np.unique(grams & _mask(k + 1), return_inverse=True)
            c = np.bincount(which, counts, len(pairs))
            contexts, of = np.unique(pairs >> np.uint64(8), return_inverse=True)
            n, t = np.bincount(of, c, len(contexts)), np.bincount(of, minlength=len(contexts))
            rest = leave = np.zeros(len(contexts))
            if shorter is not None:
                pairs_before, c_before, contexts_before, n_before, t_before = shorter
                known = np.bincount(of, c_before[np.searchsorted(pairs_before, pairs & _mask(k))], len(contexts))
                parent = np.searchsorted(contexts_before, contexts & _mask(k - 1))
                others, kinds = n_before[parent] - known, t_before[parent] - t
                left = kinds > 0
                rest = np.log2(np.where(left, others + kinds, 1))
                leave = np.where(left, np.log2(np.where(left, others + kinds, 1) / np.where(left, kinds, 1)), 0)
            self.levels.append(
                Level(
                    contexts, _units(np.log2(n + t)), _units(np.log2((n + t) / np.maximum(t, 1))),
                    _units(rest), _units(leave), pairs, _units(np.log2(c)),
                )
            )
            shorter = pairs, c, contexts, n, t
        kinds = len(self.levels[0].pairs)
        self.floor = int(_units(np.log2(np.array(max(1, 256 - kinds)))))

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Units of the last byte of each string after the bytes before it."""
        total = np.zeros(len(grams), np.int64)
        coding = np.ones(len(grams), bool)
        longer, child = np.zeros(len(grams), bool), np.zeros(len(grams), np.int64)
        above: Level | None = None
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            at, there = _find(level.contexts, (grams >> np.uint64(8)) & _mask(k))
            pair, seen = _find(level.pairs, grams & _mask(k + 1))
            if len(level.contexts):
                whole, out = level.coded[at], level.escape[at]
                if above is not None and len(above.contexts):
                    whole, out = np.where(longer, above.rest[child], whole), np.where(longer, above.leave[child], out)
                step = np.where(seen, whole - level.seen[pair], out)
                total += np.where(coding & there, step, 0)
                coding &= ~seen
            longer, child, above = there, at, level
        return total + np.where(coding, self.floor, 0)


class Coder:
    """Code lengths in all languages; a task remembers those that it asked for before."""

    def __init__(self, trees: list[Tree], slots: int = _SLOTS) -> None:
        self.trees = trees
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.keys = np.full(slots, np.iinfo(np.uint64).max)
        self.units = np.zeros((slots, len(trees)), np.int32)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        slot = self._slots(grams)
        missing = self.keys[slot] != grams
        found = self.units[slot]
        if missing.any():
            asked = grams[missing]
            new = np.unique(asked)
            made = np.stack([tree.lengths(new) for tree in self.trees], axis=1).astype(np.int32)
            found[missing] = made[np.searchsorted(new, asked)]
            into, one = np.unique(self._slots(new), return_index=True)
            self.keys[into], self.units[into] = new[one], made[one]
        return found

    def _slots(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint64(0x9E3779B97F4A7C15)) >> self.shift


def _strings(data: np.ndarray, order: int) -> np.ndarray:
    """Every byte from the ``order``-th on, with the bytes before it, as one number."""
    size = max(0, len(data) - order)
    grams = np.zeros(size, np.uint64)
    for j in range(order + 1):
        grams <<= np.uint64(8)
        grams |= data[j : j + size]
    return grams


def _padded(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes after blank lines, and where the strings of each begin and end."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    pad = b"\n" * order
    sizes = np.array([len(r) for r in raw], np.int64)
    begin = np.cumsum(sizes + order) - (sizes + order)
    return np.frombuffer(b"".join(p for r in raw for p in (pad, r)), np.uint8), begin, begin + sizes


def _counts(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = values(batch, "lang"), values(batch, "text")
            for lang in sorted(set(langs)):
                data, begin, end = _padded([t for t, g in zip(texts, langs) if g == lang], order)
                grams = _strings(data, order)
                inside = np.zeros(len(grams) + 1, np.int64)
                np.add.at(inside, begin, 1)
                np.add.at(inside, end, -1)
                known, n = np.unique(grams[np.cumsum(inside[:-1]) > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(known), pa.string()), pa.array(known.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    return run


def sample(docs: DataFrame, bound: int = FIT_ROWS) -> DataFrame:
    """At most ``bound`` rows (lang, text) a language, the same ones whatever the partitioning."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64(F.lit("ppm"), "doc_id", "text").alias("pick"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("of")).orderBy(F.desc("of"), "lang").limit(MAX_LANGUAGES)
    # Twice the rows asked for pass the hash; ranks end the sample at its bound.
    some = rows.join(F.broadcast(sizes), "lang").where(
        F.pmod("pick", F.lit(_PICK)) < F.lit(2.0 * bound * _PICK) / F.col("of")
    )
    rank = F.row_number().over(W.partitionBy("lang").orderBy("pick", "text"))
    return some.withColumn("rank", rank).where(F.col("rank") <= bound).select("lang", "text")


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]
    order: int


def fit(docs: DataFrame, order: int = ORDER, bound: int = FIT_ROWS) -> Model:
    """Trees of all languages of the rows (doc_id, lang, text) to learn from."""
    if not 1 <= order <= 6:
        raise ValueError("a context and its byte are one 64-bit number")
    counted = (
        map_parts(sample(docs, bound), _counts(order), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    made = counted.toArrow()  # of the sampled texts alone
    lang = np.array(made.column("lang").to_pylist(), object)
    grams, n = (made.column(c).to_numpy() for c in ("gram", "n"))
    languages = sorted(set(lang.tolist()))
    trees = []
    for name in languages:
        own = lang == name
        trees.append(Tree(grams[own].astype(np.uint64), n[own].astype(np.float64), order))
    return Model(languages, trees, order)


def bits(coder: Coder, texts: list[str], order: int) -> np.ndarray:
    """Units of the code of each text in each language."""
    data, begin, end = _padded(texts, order)
    total = np.zeros((len(texts), len(coder.trees)), np.int64)
    chunk = max(1, _CHUNK // len(coder.trees))
    for low in range(0, len(data) - order, chunk):
        high = min(low + chunk, len(data) - order)
        lengths = coder.lengths(_strings(data[low : high + order], order))
        first, last = np.searchsorted(end, low, "right"), np.searchsorted(begin, high)
        here = np.arange(first, last)
        a, b = np.maximum(begin[here], low) - low, np.minimum(end[here], high) - low
        here, a, b = here[a < b], a[a < b], b[a < b]
        if len(here):
            # Sums of [a, b), those between them left out; a last row lets b be the end.
            lengths = np.concatenate([lengths, np.zeros((1, lengths.shape[1]), lengths.dtype)])
            edges = np.stack([a, b], axis=1).ravel()
            total[here] += np.add.reduceat(lengths, edges, axis=0, dtype=np.int64)[::2]
    return total


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, lang_pred, score (its share among all languages) and bits of its code."""
    names, order = model.languages, model.order
    sent = docs.sparkSession.sparkContext.broadcast(model.trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(sent.value) if names else None
        for batch in batches:
            texts = values(batch, "text")
            read = [i for i, t in enumerate(texts) if t is not None and names]
            langs, scores, lengths = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            if read:
                found = bits(coder, [texts[i] for i in read], order) / UNIT
                best = found.argmin(axis=1)
                shortest = found.min(axis=1)
                scores[read] = 1 / np.exp2(shortest[:, None] - found).sum(axis=1)
                lengths[read] = shortest
                for i, b in zip(read, best):
                    langs[i] = names[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores), pa.array(lengths)],
                names=["doc_id", "lang_pred", "score", "bits"],
            )

    return map_parts(
        docs.select(F.col("doc_id").cast("long"), _lettered().alias("text")),
        run,
        "doc_id long, lang_pred string, score double, bits double",
    )


def _lettered() -> Column:
    """The text if it has a letter, else NULL."""
    return F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
