"""Toxicity: non-negative positive-unlabelled learning.

Linear numpy classifiers are trained from confirmed toxic documents (P) and a
sample of documents whose label is not looked at (U).  With the class prior p
the risk of a score f is  p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]);  when
the bracket falls below zero the step goes the other way, which undoes
overfitting (Kiryo et al. 2017).  l is the logistic loss; weights are shrunk by
a soft threshold.  The prior is the share of toxic documents among the labelled
training rows.

P and U are bounded samples (``FIT_TOXIC``, ``FIT_UNLABELLED``) picked by a hash
of the id, dealt to a few shards; the classifiers of the shards are averaged.
A feature says that a word, or words with a common beginning, come at least
once, twice or four times in the text (hashed); one bad word counts the same in
a short and in a very long text.  Only features that are more frequent in P than
in U by ``SELECT`` standard errors are trained.

Defined results: NULL and empty texts get the score of the bias; a NULL id is
scored and never trained on; repeated rows are scored once each; without any
confirmed toxic document every score is 0.0.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import map_batches, map_parts, one_each, sampled, scores_frame, shard, values

BITS = 18
FIT_TOXIC = 3_000
FIT_UNLABELLED = 20_000
SHARD_TOXIC = 1_000
#: Tasks that turn the sampled texts into features.
FIT_TASKS = 16
ITERATIONS = 300
RATE, L1, L2 = 0.5, 1e-3, 1e-4
SELECT = 4.0
#: Lengths in bytes of word beginnings, and the counts from which a level is reached.
PREFIXES = (4, 5, 6, 7, 8, 9, 10)
LEVELS = (1, 2, 4)
THRESHOLD = 0.7
#: Entries of a task's word cache before it starts anew.
CACHE = 200_000

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def _ids(parts: list[bytes]) -> list[int]:
    return [(zlib.crc32(p) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - BITS) for p in parts]


def _words(text: str | None) -> Counter[bytes]:
    return Counter(_WORD.findall((text or "").encode("utf-8", "replace").lower()))


def _parts(word: bytes) -> list[bytes]:
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) >= k)]


def features(text: str | None) -> np.ndarray:
    counts: Counter[bytes] = Counter()
    for word, n in _words(text).items():
        for part in _parts(word):
            counts[part] += n
    reached = [p + b"#" * i for p, n in counts.items() for i, at in enumerate(LEVELS) if n >= at]
    return np.unique(np.array(_ids(reached), np.int32))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _flat(rows: list[np.ndarray], column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the rows' features that have one, and the row of each."""
    kept = [found[found >= 0] for found in (column[r] for r in rows)]
    at = np.repeat(np.arange(len(rows)), [len(k) for k in kept])
    return np.concatenate([*kept, np.empty(0, column.dtype)]), at


def _frequencies(rows: list[np.ndarray], size: int) -> np.ndarray:
    """In how many rows each feature is; a row has a feature once."""
    total = np.zeros(size, np.int64)
    for row in rows:
        total[row] += 1
    return total


def fit_nnpu(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Weights for ``2**BITS`` features and the bias, by full-batch descent on the nnPU risk."""
    size, n_p, n_u = 1 << BITS, len(toxic), max(len(unlabelled), 1)
    df_p, df_u = _frequencies(toxic, size), _frequencies(unlabelled, size)
    in_p, in_u = (df_p + 0.5) / (n_p + 1), (df_u + 0.5) / (n_u + 1)
    both = (df_p + df_u + 1) / (n_p + n_u + 2)
    surplus = (in_p - in_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    used = np.flatnonzero((surplus >= SELECT) & (df_p >= 2))
    column = np.full(size, -1, np.int32)
    column[used] = np.arange(len(used))
    ip, rp = _flat(toxic, column)
    iu, ru = _flat(unlabelled, column)
    k = len(used)
    share = (np.bincount(ip, minlength=k) + np.bincount(iu, minlength=k) + 1) / (n_p + n_u)
    share = np.minimum(share, 1)
    scale = 1 / np.sqrt(share * (1 - share) + 1e-3)
    centre = share * scale
    w, b = np.zeros(k), 0.0
    for _ in range(ITERATIONS):
        ws, shift = w * scale, b - float(w @ centre)
        fp = np.bincount(rp, ws[ip], n_p) + shift
        fu = np.bincount(ru, ws[iu], n_u) + shift
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if rest >= 0:
            gp, gu = np.full(n_p, -prior / n_p), _sigmoid(fu) / n_u
        else:
            gp, gu = prior * _sigmoid(fp) / n_p, -_sigmoid(fu) / n_u
        total = gp.sum() + gu.sum()
        g = (np.bincount(ip, gp[rp], k) + np.bincount(iu, gu[ru], k)) * scale - centre * total
        w -= RATE * (g + L2 * w)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * L1, 0)
        b -= RATE * total
    out = np.zeros(size + 1)
    out[used] = w * scale
    out[-1] = b - float(w @ centre)
    return out


def _featurise(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = [features(t).tobytes() for t in values(batch, "text")]
    at = batch.schema.get_field_index("text")
    return batch.set_column(at, "ids", pa.array(ids, pa.binary()))


def _fit_shard(rows: pd.DataFrame, prior: float) -> pd.DataFrame:
    rows = rows.sort_values(["toxic", "doc_id", "ids"])
    made = [np.frombuffer(b, np.int32) for b in rows["ids"]]
    is_toxic = rows["toxic"].to_numpy() == 1
    toxic = [m for m, t in zip(made, is_toxic) if t and len(m)]
    if not toxic:
        return pd.DataFrame({"weights": pd.Series([], dtype=object)})
    w = fit_nnpu(toxic, [m for m, t in zip(made, is_toxic) if not t], prior)
    return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()]})


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fit_toxic: int = FIT_TOXIC,
    fit_unlabelled: int = FIT_UNLABELLED,
) -> np.ndarray | None:
    """A model from texts of the training fold and confirmed labels; None without toxic ones.

    ``docs`` has doc_id and text, ``labels`` doc_id and label (1: toxic).  Labels
    name the members of P and give the prior; U is drawn from all of ``docs``.
    Of several rows of one id one is used.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").alias("label")
    )
    seen = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    total, ones = int(seen[0]), int(seen[1])
    if not ones:
        return None
    prior = min(max(ones / total, 1e-4), 0.9)
    shards = max(1, min(ones, fit_toxic) // SHARD_TOXIC)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    confirmed = sampled(known.where("label = 1").select("doc_id"), "doc_id", fit_toxic, ones)
    drawn = sampled(texts, "doc_id", fit_unlabelled)
    rows = one_each(texts.join(confirmed, "doc_id"), "doc_id").withColumn("toxic", F.lit(1)).unionByName(
        one_each(drawn, "doc_id").withColumn("toxic", F.lit(0))
    )
    spread = rows.select("doc_id", "toxic", "text").repartition(FIT_TASKS, "doc_id")
    ready = map_batches(spread, _featurise, "doc_id long, toxic int, ids binary")
    made = ready.withColumn("shard", shard("doc_id", shards)).groupBy("shard").applyInPandas(
        lambda pdf: _fit_shard(pdf, prior), "weights binary"
    ).collect()  # one array of fixed size per shard, FIT_TOXIC / SHARD_TOXIC of them
    if not made:
        return None
    return np.mean([np.frombuffer(r["weights"], np.float32) for r in made], axis=0)


class Scorer:
    """Scores texts by a model; remembers which beginnings of a word weigh anything."""

    def __init__(self, model: np.ndarray | None) -> None:
        self.weights = {}
        if model is not None:
            used = np.flatnonzero(model[:-1])
            self.weights = dict(zip(used.tolist(), model[used].astype(float).tolist()))
            self.bias = float(model[-1])
        self.words: dict[bytes, tuple[tuple[int, ...], ...]] = {}

    def _look_up(self, word: bytes) -> tuple[tuple[int, ...], ...]:
        """Of each beginning that weighs anything, the features of its levels."""
        if len(self.words) >= CACHE:
            self.words.clear()
        found = []
        for part in _parts(word):
            ids = tuple(_ids([part + b"#" * i for i in range(len(LEVELS))]))
            if not self.weights.keys().isdisjoint(ids):
                found.append(ids)
        self.words[word] = kept = tuple(found)
        return kept

    def __call__(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        counts: dict[tuple[int, ...], int] = {}
        for word, n in _words(text).items():
            known = self.words.get(word)
            if known is None:
                known = self._look_up(word)
            for part in known:
                counts[part] = counts.get(part, 0) + n
        ids = {i for part, n in counts.items() for i, at in zip(part, LEVELS) if n >= at}
        return float(_sigmoid(self.bias + sum(self.weights.get(i, 0.0) for i in sorted(ids))))


def score(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """doc_id and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            scores = [scorer(t) for t in values(batch, "text")]
            yield scores_frame(values(batch, "doc_id"), "score", scores)

    return map_parts(docs.select("doc_id", "text"), run, "doc_id long, score double")


def keep_clean(
    docs: DataFrame, model: np.ndarray | None, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            clean = [scorer(t) < threshold for t in values(batch, "text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_parts(docs, work, docs.schema)
