"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Training rows are a bounded sample of the labelled rows (``FIT_ROWS``, picked
by a hash of the id), dealt to a few shards; each shard runs the follow-the-
regularised-leader updates over its rows and the weights of the shards are
averaged.  A model is one array of fixed size, so it can be sent to all tasks;
a score is a sparse dot product of the whole text's features with it.

Defined results: NULL and empty texts have no features and get the score of the
bias; a NULL id is scored like any row and never trained on; repeated rows are
scored once each; without usable labels of both classes the model is constant
(the share of label 1, or 0.5 without labels).  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import map_batches, one_each, sampled, scores_frame, shard, values

BITS = 18
FIT_ROWS = 24_000
SHARD_ROWS = 6_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.02, 0.1
THRESHOLD = 0.3

# Letters of any script form words; other visible characters form tokens too.
_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[^A-Za-z\x80-\xff\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_MIX3 = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(64 - BITS)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids and weights (length 1 in all) of unigrams, bigrams and repeats.

    A bigram of equal tokens, and equal tokens at a distance of two, also count
    for a shared feature: repetition looks the same whatever is repeated.
    """
    tokens = _TOKEN.findall((text or "").encode("utf-8", "replace"))
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    one = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens)) * _MIX
    two = one[:-1] * np.uint64(3) + one[1:] * _MIX2
    two = (two ^ (two >> np.uint64(29))) * _MIX3
    repeats = int((one[:-1] == one[1:]).sum()), int((one[:-2] == one[2:]).sum())
    extra = np.repeat(np.array([1, 2], np.uint64) * _MIX3, repeats)
    ids, counts = np.unique(np.concatenate([one, two, extra]) >> _SHIFT, return_counts=True)
    x = np.sqrt(counts)
    return ids.astype(np.int64), x / math.sqrt(float(counts.sum()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights after ``EPOCHS`` passes; the last entry is the bias."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            ids, x = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            zi, ni = z[ids], n[ids]
            w = _weights(zi, ni)
            g = (_sigmoid(w @ x) - labels[i]) * x
            z[ids] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[ids] = ni + g * g
    return _weights(z, n)


def _fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "text"])
    w = ftrl([features(t) for t in rows["text"]], rows["label"].to_numpy(float))
    return pd.DataFrame({"n": [len(rows)], "weights": [w.astype(np.float32).tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """A model of ``2**BITS + 1`` weights from texts and 0/1 labels.

    ``docs`` has doc_id and text, ``labels`` doc_id and label.  At most about
    ``fit_rows`` labelled rows are used.  Of several labels of a document the
    largest counts, and of several rows of one id one.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").alias("label")
    )
    seen = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    total, ones = int(seen[0]), int(seen[1])
    model = np.zeros((1 << BITS) + 1, np.float32)
    if ones in (0, total):
        model[-1] = 0.0 if not total else 10.0 if ones else -10.0
        return model
    shards = max(1, min(total, fit_rows) // SHARD_ROWS)
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        sampled(known, "doc_id", fit_rows, total), "doc_id"
    )
    rows = one_each(labelled, "doc_id").withColumn("shard", shard("doc_id", shards))
    made = rows.groupBy("shard").applyInPandas(
        lambda pdf: _fit_shard(pdf), "n long, weights binary"
    ).collect()  # one array of fixed size per shard, FIT_ROWS / SHARD_ROWS of them
    if made:
        parts = [np.frombuffer(r["weights"], np.float32) * r["n"] for r in made]
        model = (np.sum(parts, axis=0) / sum(r["n"] for r in made)).astype(np.float32)
    return model


def score_text(model: np.ndarray, text: str | None) -> float:
    ids, x = features(text)
    return float(_sigmoid(float(model[ids] @ x) + float(model[-1])))


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [score_text(sent.value, t) for t in values(batch, "text")]
        return scores_frame(values(batch, "doc_id"), "score", scores)

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, score double")


def keep_good(docs: DataFrame, model: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [score_text(sent.value, t) >= threshold for t in values(batch, "text")]
        return batch.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, work, docs.schema)
