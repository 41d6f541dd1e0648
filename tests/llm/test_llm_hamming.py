"""Top-k lists against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import hamming
from tallyroom.llm.common import Workspace


def brute(rows, asked, k, bits):
    codes = {}
    for i, v in rows:
        if i is None or v is None:
            continue
        code = sum(1 << j for j, x in enumerate(v[:bits]) if x is not None and not math.isnan(x) and x > 0)
        # Of an id's codes the smallest counts, as signed numbers of 64 bits.
        words = [code >> first & (1 << 64) - 1 for first in range(0, bits, 64)]
        signed = [w - ((w >> 63) << 64) for w in words]
        codes[i] = min((signed, code), codes.get(i, (signed, code)))
    codes = {i: code for i, (_, code) in codes.items()}
    out = set()
    for q in codes:
        if asked(q):
            near = sorted(((codes[q] ^ codes[n]).bit_count(), n) for n in codes if n != q)[:k]
            out |= {(q, rank + 1, n, d) for rank, (d, n) in enumerate(near)}
    return out


def search(spark, rows, k, bits):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, code int, id int")
    with Workspace(spark, "test-hamming") as space:
        found = hamming.search(table, F.col("vec_id") % 5 == 0, k, space, bits=bits).collect()
    return {tuple(r) for r in found}, len(found)


@pytest.mark.parametrize(("n", "bits", "k"), [(120, 16, 4), (60, 64, 10), (5, 8, 10)])
def test_random_codes(spark, n, bits, k):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=bits).tolist()) for i in range(n)]
    found, count = search(spark, rows, k, bits)
    assert found == brute(rows, lambda i: i % 5 == 0, k, bits) and count == len(found)


def test_ties_copies_and_odd_vectors(spark):
    hot = [1.0] * 6 + [-1.0] * 6
    rows = [(i, hot) for i in range(40)] + [(50, [1.0] * 12), (51, None), (None, hot), (55, [float("nan"), 1.0])]
    rows += [(60, hot), (60, hot), (60, [1.0]), (65, []), (66, [None, 2.0, -0.0, 0.0]), (70, [1.0] * 30)]
    # The longest vector, of 30 values, gives the width of all codes.
    found, count = search(spark, rows, 3, None)
    assert found == brute(rows, lambda i: i % 5 == 0, 3, 30) and count == len(found)


def test_values_beyond_64_count(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0] * 64 + rng.normal(size=66).tolist()) for i in range(70)]
    found, count = search(spark, rows, 4, None)
    assert found == brute(rows, lambda i: i % 5 == 0, 4, 130) and count == len(found)
    assert {d for *_, d in found} != {0}
    with pytest.raises(ValueError, match="130 values"):
        search(spark, rows, 4, 64)
