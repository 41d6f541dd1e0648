"""Fill-in-middle transformation: cuts found through a learned rank index.

A text of n code points is cut at two ranks taken from a hash of its document's id.
Texts are UTF-8 bytes, so a cut needs the byte offset of a code point's rank.  The
offsets of all boundaries of a batch of texts are learned once: straight segments,
each within ``ERROR`` bytes of every boundary it covers, and for every boundary the
distance that its segment misses it by, in one signed byte.  A cut is predicted by its
segment and corrected by its residual, which gives the exact offset.

The segments are fitted greedily: from its first boundary a segment grows as long as
one slope passes all its boundaries within the error.  Boundaries are read in windows
of ``WINDOW`` bytes, so beside the texts a task holds one byte a boundary.

Forms, with the three sentinels around the parts:

    psm    P prefix S suffix M middle
    spm    S suffix P prefix M middle
    plain  the text as it is: empty, a sentinel in it, or left alone by its hash

Defined results: a NULL text is the empty text; the hash of a NULL id is that of no
digits; repeated rows give the same row each; other columns of any name are not read
and do not come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import map_batches

ERROR = 100
WINDOW = 1 << 20
#: Boundaries that a segment is first tried on; doubled as long as it holds.
_FIRST_TRY = 256


@dataclass(frozen=True)
class Format:
    """Sentinels, the seed of the hash, and how many of a hundred texts get which form."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1:"
    transformed: int = 90
    spm: int = 20

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        for (i, a), (j, b) in product(enumerate(marks), repeat=2):
            if not a or i != j and b in a or any(a.endswith(b[:n]) for n in range(1, len(b)) if n < len(a)):
                raise ValueError("a sentinel overlaps another or itself")


class RankIndex:
    """Byte offsets of the code point boundaries of a buffer, by rank."""

    def __init__(self, data: np.ndarray, error: int = ERROR, window: int = WINDOW) -> None:
        if not 1 <= error <= 126:
            raise ValueError("residuals are one signed byte")
        self.n = 0
        first, base, slope, residual = [], [], [], []
        for begin in range(0, len(data) + 1, window):
            # All bytes but those that continue a code point, and the end of the buffer.
            part = data[begin : begin + window]
            offsets = np.flatnonzero((part & 0xC0) != 0x80) + begin
            if begin + window > len(data):
                offsets = np.append(offsets, len(data))
            at = 0
            while at < len(offsets):
                rise, size = _segment(offsets[at:], error)
                first.append(self.n + at)
                base.append(int(offsets[at]))
                slope.append(rise)
                guess = _line(offsets[at], rise, np.arange(size))
                residual.append((offsets[at : at + size] - guess).astype(np.int8))
                at += size
            self.n += len(offsets)
        self.first = np.array(first, np.int64)
        self.base = np.array(base, np.int64)
        self.slope = np.array(slope, np.float64)
        self.residual = np.concatenate(residual)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offset of each boundary, by prediction and residual."""
        at = np.searchsorted(self.first, ranks, "right") - 1
        return _line(self.base[at], self.slope[at], ranks - self.first[at]) + self.residual[ranks]

    def ranks(self, offsets: np.ndarray) -> np.ndarray:
        """The rank of each boundary with a known offset, by bisection on predicted ones."""
        low, high = np.zeros(len(offsets), np.int64), np.full(len(offsets), self.n - 1)
        while (low < high).any():
            mid = (low + high) >> 1
            below = self.offsets(mid) < offsets
            low, high = np.where(below, mid + 1, low), np.where(below, high, mid)
        return low


def _line(base, slope, steps):
    return base + np.floor(slope * steps + 0.5).astype(np.int64)


def _segment(offsets: np.ndarray, error: int) -> tuple[float, int]:
    """Slope and size of the longest segment from the first offset on."""
    tried, low, high = 1, -np.inf, np.inf
    size = _FIRST_TRY
    while tried < len(offsets):
        steps = np.arange(tried, min(size, len(offsets)))
        rise = (offsets[steps] - offsets[0]).astype(np.float64)
        lows = np.maximum(np.maximum.accumulate((rise - error) / steps), low)
        highs = np.minimum(np.minimum.accumulate((rise + error) / steps), high)
        broken = np.flatnonzero(lows > highs)
        if len(broken):
            last = int(broken[0])
            if last:
                low, high = lows[last - 1], highs[last - 1]
            tried += last
            break
        low, high, tried, size = lows[-1], highs[-1], tried + len(steps), size * 2
    return (0.0 if tried == 1 else (low + high) / 2), tried


def _buffer(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where in them each begins and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, fmt: Format = Format()) -> DataFrame:
    """Per row: n code points, form, parts' sizes (NULL if plain), and the output text."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(fmt.seed), digits), 256)
    hashes = [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)
    ]
    marks = [m.encode() for m in (fmt.prefix, fmt.suffix, fmt.middle)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.string())
        data, starts = _buffer(texts)
        index = RankIndex(data)
        ranks = index.ranks(starts)
        n = np.diff(ranks)
        h1, h2, h3, h4 = (batch.column(2 + i).to_numpy() for i in range(4))
        one, two = h1 % (n + 1), h2 % (n + 1)
        low, high = np.minimum(one, two), np.maximum(one, two)
        cuts = index.offsets(np.stack([ranks[:-1] + low, ranks[:-1] + high]))
        raw = data.tobytes()
        forms, outputs = [], []
        for i, (a, b, c, d) in enumerate(zip(starts[:-1], cuts[0], cuts[1], starts[1:])):
            text = raw[a:d]
            if not text or h3[i] % 100 >= fmt.transformed or any(m in text for m in marks):
                form, output = "plain", text
            else:
                p, s, m = (mark + part for mark, part in zip(marks, (raw[a:b], raw[c:d], raw[b:c])))
                form, output = ("spm", s + p + m) if h4[i] % 100 < fmt.spm else ("psm", p + s + m)
            forms.append(form)
            outputs.append(output)
        plain = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n),
                pa.array(forms, pa.string()),
                pa.array(low, pa.int64(), mask=plain),
                pa.array(high - low, pa.int64(), mask=plain),
                pa.Array.from_buffers(pa.string(), len(outputs), pa.array(outputs, pa.binary()).buffers()),
            ],
            names=[part.split()[0] for part in _OUT.split(", ")],
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *hashes)
    return map_batches(rows, work, _OUT)


def restored(fmt: Format = Format(), output: str = "output", form: str = "form") -> Column:
    """The text, rebuilt from the output and its form alone."""
    text = F.col(output)

    def parts(first: str, second: str, third: str) -> Iterator[Column]:
        """What follows each of the three sentinels."""
        rest = F.substr(text, F.lit(len(first) + 1))
        yield F.substring_index(rest, second, 1)
        yield F.substring_index(F.substr(rest, F.length(F.substring_index(rest, second, 1)) + len(second) + 1), third, 1)
        # No part contains a sentinel, so the last one is the third.
        yield F.substring_index(text, third, -1)

    psm_prefix, psm_suffix, psm_middle = parts(fmt.prefix, fmt.suffix, fmt.middle)
    spm_suffix, spm_prefix, spm_middle = parts(fmt.suffix, fmt.prefix, fmt.middle)
    return (
        F.when(F.col(form) == "psm", F.concat(psm_prefix, psm_middle, psm_suffix))
        .when(F.col(form) == "spm", F.concat(spm_prefix, spm_middle, spm_suffix))
        .otherwise(text)
    )
