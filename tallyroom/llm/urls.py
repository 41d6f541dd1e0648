"""URL filter: rules first, then a ratio of two character language models.

Every url is judged by the longest rule that fits its host and path.  Urls that
a rule decides are examples: allowed ones train the model of accepted urls,
blocked ones that of rejected urls.  Both are variable-order Markov models over
the bytes of the url and an end mark, contexts of 0 to ``ORDER`` bytes, smoothed
by Witten-Bell interpolation with the next shorter context.  All counts are kept.
Up to ``MAX_PAIRS`` (context, byte) pairs an order are sent to the tasks.  More stay a
table: the distinct pairs that the urls ask for are joined with their counts in all
orders, and their log ratios, order by order from the shortest, go back to the urls
by another join.  Pairs that make up at least ``1 / MAX_PAIRS`` of what is asked (at
most MAX_PAIRS) are sent to the tasks, so no key of that join has a larger share.

The score of a url is the difference of its log-likelihoods divided by its
length; log ratios are summed in whole units of ``1 / UNIT``, in any order.  The threshold is calibrated on examples held out of the counts (a hash
of the url): the one with the best mean of both classes' accuracies, read from a
histogram of fixed size.

Defined results: a NULL url, or one without ``://``, has an empty host and path;
without a rule it is scored as the text it is (NULL: empty).  Repeated rows count
and are judged once each; ties of rules of equal length go to the smaller text;
without examples of both classes every undecided url is allowed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace, ascii_lower

ORDER = 5
MAX_PAIRS = 1 << 15
HELD_FOLDS = 5
#: Bins of the calibration histogram, over score differences of -SPAN to SPAN.
BINS, SPAN = 800, 8.0
#: Entries of a task's caches before they start anew.
CACHE = 300_000
UNIT = 1 << 32
MAX_RULES = 1_000
_END = 256

Rule = tuple[str, str]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, shape, i), F.lit("")) for i in (1, 2))
    return ascii_lower(host), path


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The text and the verdict of the longest fitting rule; NULL without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    text = verdict = F.lit(None).cast("string")
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rest)
        text = F.when(fits, F.lit(rule)).otherwise(text)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return text, verdict


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context, next) per class, combined in the task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        pairs = sorted(counts[0].keys() | counts[1].keys())
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], pa.binary()),
                pa.array([p[1] for p in pairs], pa.int32()),
                pa.array([counts[0][p] for p in pairs], pa.int64()),
                pa.array([counts[1][p] for p in pairs], pa.int64()),
            ],
            names=["context", "next", "accepted", "rejected"],
        )
        counts[0].clear()
        counts[1].clear()
        return made

    for batch in batches:
        for url, verdict in zip(*(c.to_pylist() for c in batch.columns)):
            into = counts[verdict != "allow"]
            data = url.encode("utf-8", "replace")
            for i in range(len(data) + 1):
                nxt = data[i] if i < len(data) else _END
                for k in range(min(i, ORDER) + 1):
                    into[data[i - k : i], nxt] += 1
            if len(counts[0]) + len(counts[1]) > CACHE:
                yield flush()
    yield flush()


def _keys(data: bytes) -> Iterator[tuple[bytes, int]]:
    """The longest context and the next byte of each place."""
    for i in range(len(data) + 1):
        yield data[max(0, i - ORDER) : i], data[i] if i < len(data) else _END


class Model:
    """Both smoothed models; a score is their log ratio per symbol."""

    def __init__(self, pairs: list[tuple[bytes, int, int, int]]) -> None:
        self.pairs = {(bytes(c), n): (a, r) for c, n, a, r in pairs}
        self.contexts: dict[bytes, list[int]] = {}
        for (context, _), (a, r) in self.pairs.items():
            sums = self.contexts.setdefault(context, [0, 0, 0, 0])
            for i, n in enumerate((a, r)):
                sums[i] += n
                sums[2 + i] += n > 0
        self.seen: dict[tuple[bytes, int], float] = {}

    def log_ratio(self, context: bytes, nxt: int) -> float:
        """log of P(next | context) under the accepted model over that under the rejected one."""
        key = (context, nxt)
        if key in self.seen:
            return self.seen[key]
        p = [1 / (_END + 1)] * 2
        for k in range(len(context) + 1):
            shorter = context[len(context) - k :]
            sums = self.contexts.get(shorter)
            if sums is None:
                break
            n = self.pairs.get((shorter, nxt), (0, 0))
            p = [(n[i] + sums[2 + i] * p[i]) / (sums[i] + sums[2 + i]) if sums[i] else p[i] for i in (0, 1)]
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[key] = ratio = math.log(p[0]) - math.log(p[1])
        return ratio

    def score(self, url: str | None) -> float:
        data = (url or "").encode("utf-8", "replace")
        total = sum(round(self.log_ratio(*key) * UNIT) for key in _keys(data))
        return total / UNIT / (len(data) + 1)


def _scores_by_model(rows: DataFrame, model: Model) -> DataFrame:
    """row and score of rows (row, url)."""
    sent = rows.sparkSession.sparkContext.broadcast(model.pairs)

    def run(batches):
        own = Model([(c, n, a, r) for (c, n), (a, r) in sent.value.items()])
        for batch in batches:
            scores = [own.score(u) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    return rows.select("row", "url").mapInArrow(run, "row long, score double")


_KEY_DDL = "context binary, next int, times long"


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the urls ask for, counted in the task."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in counts], pa.binary()),
                pa.array([n for _, n in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["context", "next", "times"],
        )
        counts.clear()
        return made

    for batch in batches:
        for url in batch.column(0).to_pylist():
            counts.update(_keys((url or "").encode("utf-8", "replace")))
            if len(counts) > CACHE:
                yield flush()
    yield flush()


def _ratios(asked: DataFrame, counted: DataFrame, space: Workspace) -> DataFrame:
    """``asked`` (context, next, times) with the log ratio of each in units."""
    sums = counted.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_sum") for c in ("accepted", "rejected")],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in ("accepted", "rejected")],
    )
    size = F.length("context")
    suffixes = F.transform(F.sequence(F.lit(0), size), lambda k: F.substring(F.col("context"), size - k + 1, k))
    needed = asked.select("next", F.explode(suffixes).alias("context")).distinct()
    known = space.step(needed.join(counted, ["context", "next"], "left").join(sums, "context", "left"))
    shorter = None
    levels = []
    for order in range(ORDER + 1):
        own = known.where(size == order)
        if shorter is None:
            own = own.withColumns({"p": F.lit(1 / (_END + 1)), "q": F.lit(1 / (_END + 1))})
        else:
            of = shorter.select(F.col("context").alias("rest"), "next", "p", "q")
            own = own.withColumn("rest", F.substring(F.col("context"), F.lit(2), F.lit(order))).join(of, ["rest", "next"])
        shorter = space.step(
            own.select("context", "next", *[_mixed(*x).alias(x[1]) for x in (("accepted", "p"), ("rejected", "q"))])
        )
        levels.append(shorter)
    all_levels = levels[0]
    for level in levels[1:]:
        all_levels = all_levels.unionAll(level)
    units = F.round((F.log("p") - F.log("q")) * UNIT).cast("long")
    return space.step(asked.join(all_levels, ["context", "next"]).select("context", "next", "times", units.alias("units")))


def _mixed(kind: str, p: str) -> Column:
    """Witten-Bell: a context's counts with the probability by the shorter one."""
    n, total, types = F.coalesce(kind, F.lit(0)), F.col(f"{kind}_sum"), F.col(f"{kind}_types")
    return F.when(total > 0, (n + types * F.col(p)) / (total + types)).otherwise(F.col(p))


def _scores(rows: DataFrame, counted: DataFrame, space: Workspace) -> DataFrame:
    """row and score of rows (row, url), by joins with the counts."""
    asked = space.step(
        rows.select("url").mapInArrow(_ask, _KEY_DDL).groupBy("context", "next").agg(F.sum("times").alias("times"))
    )
    total = asked.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    ratios = _ratios(asked, counted, space)
    often = -(-int(total) // MAX_PAIRS)
    cached = ratios.where(F.col("times") >= often).collect()  # MAX_PAIRS at most
    sent = rows.sparkSession.sparkContext.broadcast({(bytes(r["context"]), r["next"]): r["units"] for r in cached})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                made: list[tuple] = []
                part = batch.slice(begin, 1024)
                for row, url in zip(*(c.to_pylist() for c in part.columns)):
                    counts = Counter(_keys((url or "").encode("utf-8", "replace")))
                    units = sum(known[k] * n for k, n in counts.items() if k in known)
                    made.append((row, None, None, units, sum(counts.values())))
                    made += [(row, *k, n, 0) for k, n in counts.items() if k not in known]
                types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*made), types)],
                    names=["row", "context", "next", "n", "places"],
                )

    taken = space.step(
        rows.select("row", "url").mapInArrow(run, "row long, context binary, next int, n long, places long")
    )
    rest = (
        taken.where("context IS NOT NULL")
        .join(ratios.where(F.col("times") < often), ["context", "next"])
        .select("row", (F.col("n") * F.col("units")).alias("units"), F.lit(0).cast("long").alias("places"))
    )
    return (
        taken.where("context IS NULL")
        .select("row", F.col("n").alias("units"), "places")
        .unionAll(rest)
        .groupBy("row")
        .agg((F.sum("units") / F.lit(float(UNIT)) / F.sum("places")).alias("score"))
    )


def _threshold(held: DataFrame) -> float:
    """The lowest bin edge with the best mean accuracy of both classes; 0 without examples.

    ``held`` has the verdict and the score of examples.
    """
    place = F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS)
    bins = (
        held.groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).alias("bin"))
        .agg(
            F.sum((F.col("verdict") == "allow").cast("long")).alias("accepted"),
            F.sum((F.col("verdict") == "block").cast("long")).alias("rejected"),
        )
        .collect()  # BINS rows at most
    )
    n_a, n_r = sum(b["accepted"] for b in bins), sum(b["rejected"] for b in bins)
    if not n_a or not n_r:
        return 0.0
    best, at, above, below = -1.0, 0.0, n_a, 0
    by_bin = {b["bin"]: b for b in bins}
    for i in range(BINS + 1):
        edge = (i / BINS * 2 - 1) * SPAN
        value = above / n_a + below / n_r
        if value > best + 1e-12 or (value > best - 1e-12 and abs(edge) < abs(at)):
            best, at = value, edge
        if i in by_bin:
            above -= by_bin[i]["accepted"]
            below += by_bin[i]["rejected"]
    return at


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, verdict, and the score where no rule decided."""
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").withColumns(
        {"host": host, "path": path}
    )
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": text, "verdict": verdict})
    with Workspace(pages.sparkSession, "urls") as space:
        return space.keep(_judged(rows, space))


def _judged(rows: DataFrame, space: Workspace) -> DataFrame:
    columns = rows.columns
    held = F.coalesce(F.xxhash64(F.lit("held"), "url") % HELD_FOLDS == 0, F.lit(False))
    rows = space.step(rows.withColumns({"row": F.monotonically_increasing_id(), "held": held}))
    examples = rows.where("verdict IS NOT NULL AND NOT held")
    sizes = examples.agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("a"),
        F.sum((F.col("verdict") != "allow").cast("long")).alias("r"),
    ).first()
    if not sizes["a"] or not sizes["r"]:
        return rows.select(*columns, F.lit(None).cast("double").alias("score")).withColumn(
            "verdict", F.coalesce("verdict", F.lit("allow"))
        )
    counted = space.step(
        examples.select("url", "verdict")
        .mapInArrow(_count, "context binary, next int, accepted long, rejected long")
        .groupBy("context", "next")
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    )
    asked = rows.where("verdict IS NULL OR held")
    if counted.count() <= MAX_PAIRS * (ORDER + 1):
        pairs = counted.collect()  # MAX_PAIRS an order
        scores = _scores_by_model(
            asked, Model([(p["context"], p["next"], p["accepted"], p["rejected"]) for p in pairs])
        )
    else:
        scores = _scores(asked, counted, space)
    scored = space.step(rows.join(space.step(scores), "row", "left"))
    threshold = _threshold(scored.where("verdict IS NOT NULL AND held"))
    by_score = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    score = F.when(F.col("verdict").isNull(), F.col("score")).alias("score")
    return scored.select(*columns, score).withColumn("verdict", F.coalesce("verdict", by_score))
