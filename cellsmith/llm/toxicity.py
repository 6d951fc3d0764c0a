"""Toxic passages: maximum-scoring segments of token log-odds.

Fit (on at most ``FIT_ROWS`` labelled rows, the least by hash of the id, so
the bound does not depend on the order of the input): unit counts of toxic and
clean documents, one per document, so that a text repeating a word does not
count for many, give log-odds with an informative Dirichlet prior, a
``PRIOR`` share of the pooled counts.  Units are words and, for unknown words,
their first ``STEM`` letters; those with a z-score of at least ``Z`` either way are kept,
the ``UNITS`` strongest.  A token scores its log-odds less ``DRIFT``, any other
token ``-DRIFT``, so clean text has a negative mean.

Search: a linear-time scan finds all maximal-scoring segments of the whole
text (each positive token extends or merges the segments to its left).

Calibration: for clean text, the number of segments that score above ``x`` in
``n`` tokens is about Poisson with mean ``k n exp(-rate x)``.  ``rate`` solves
``sum p exp(rate s) = 1`` over the clean token distribution; ``k`` follows from
the best segments of the clean fit documents by maximum likelihood.  A segment
with a mean of at most ``PASSAGE`` is a significant passage.  A document's
evidence is the largest over ``r`` of minus the log chance of ``r`` segments
as good as its ``r``-th; a logistic curve fitted on the same rows maps it to 0 to 1.

Cases: null and empty texts have no segment and the score of no evidence;
null labels, ids without a document and documents without a label are not
fitted on; an id labelled twice is toxic if any label says so; without toxic
or clean rows to fit, nothing is toxic; repeated rows are scored alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import id_crc, private

FIT_ROWS, UNITS, STEM, Z, PRIOR, DRIFT, PASSAGE, THRESHOLD = 20_000, 20_000, 5, 3.5, 0.1, 0.2, 0.01, 0.7
MAX_EVIDENCE, BINS = 40.0, 160
CACHE = 400_000
WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    """Scores of words and of stems (``stem*``), and the calibration."""

    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    offset: float = -4.0


class _Scores(dict):
    """Score by word; words not met before are looked up, the table is bounded."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            got = self.known.get(word[:STEM] + "*", 0.0) if len(word) >= STEM else 0.0
        if len(self) >= CACHE:
            self.clear()
        self[word] = got
        return got


def segments(values: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)``, in linear time."""
    at = np.flatnonzero(values > 0)
    if not len(at):
        return []
    total = np.concatenate([[0.0], np.cumsum(values)])
    kept: list[list] = []  # start, end, sum before, sum behind, link to the nearest segment with a lesser sum before
    for i in at.tolist():
        cur = [i, i + 1, total[i], total[i + 1], -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= cur[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= cur[3]:
                cur[4] = j
                kept.append(cur)
                break
            cur[0], cur[2] = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, float(r - l)) for a, b, l, r, _ in kept]


def evidence(model: Model, n: int, scores: list[float]) -> float:
    """Minus the natural log of the chance of the best ``r`` segments, over all ``r``."""
    best = 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        mean_log = math.log(model.k * n) - model.rate * s
        if mean_log < 0:
            best = max(best, math.lgamma(r + 1) - r * mean_log)
    return min(best, MAX_EVIDENCE)


def _values(model: Model, table: _Scores, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return 0, []
    got = np.fromiter(map(table.__getitem__, words), float, len(words)) - DRIFT
    return len(words), segments(got)


def _fit_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """The fit documents with their label; the label side has at most ``rows`` rows."""
    train = labels.where((F.pmod(id_crc(), F.lit(3)) != 1) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    train = train.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    few = docs.sparkSession.createDataFrame([(int(r.doc_id), int(r.toxic)) for r in few], "_id long, toxic int")
    return docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def rows():
        units = list(counts[0].keys() | counts[1].keys())
        for i in range(0, len(units), 20_000):
            u = units[i: i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(u), *(pa.array([c[x] for x in u], pa.int64()) for c in counts)], ["unit", "clean", "toxic"])

    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            cut = batch.slice(k, 200)
            for text, y in zip(cut.column("text").to_pylist(), cut.column("toxic").to_pylist()):
                words = set(WORD.findall((text or "").lower()))
                counts[y].update(words)
                counts[y].update({w[:STEM] + "*" for w in words if len(w) >= STEM})
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield from rows()
                counts[0].clear()
                counts[1].clear()
    yield from rows()


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``."""
    train = _fit_rows(docs, labels, rows)
    counts = train.mapInArrow(_count, "unit string, clean long, toxic long").groupBy("unit").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    word = ~F.col("unit").endswith("*")
    counts = counts.cache()
    try:
        n0, n1 = counts.where(word).agg(F.sum("c"), F.sum("t")).first()
        if not n0 or not n1:
            return Model()
        a0 = PRIOR * (n0 + n1)
        prior = PRIOR * (F.col("c") + F.col("t"))
        t, c = F.col("t") + prior, F.col("c") + prior
        odds = F.log(t / (n1 + a0 - t)) - F.log(c / (n0 + a0 - c))
        scored = counts.withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / t + 1 / c)).withColumn("p", c / (n0 + a0))
        # At most UNITS rows by the limit.
        top = scored.where(F.abs("z") >= Z).orderBy(F.abs("z").desc(), "unit").limit(UNITS).collect()
    finally:
        counts.unpersist()
    model = Model(scores={r.unit: r.odds for r in top})
    # A word's stem scores for words that are not units themselves.
    share = {r.unit: r.p for r in top}
    for u, p in list(share.items()):
        if not u.endswith("*") and len(u) >= STEM and u[:STEM] + "*" in share:
            share[u[:STEM] + "*"] = max(1e-12, share[u[:STEM] + "*"] - p)
    model.rate = _rate(np.array([model.scores[u] - DRIFT for u in share]), np.array(list(share.values())))
    return _calibrate(model, train)


def _rate(scores: np.ndarray, p: np.ndarray) -> float:
    """Positive root of ``sum p exp(rate s) = 1``, the rest of the mass at ``-DRIFT``."""
    if not len(scores) or scores.max() <= 0:
        return 1.0
    rest = max(0.0, 1 - p.sum())

    def f(x):
        return float((p * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * DRIFT)) - 1

    lo, hi = 1e-6, 1e-3
    while f(hi) < 0 and hi < 100:
        lo, hi = hi, hi * 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _stats(train: DataFrame, model: Model) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Scores(model.scores)
        for batch in batches:
            n, best, ev = [], [], []
            for text in batch.column("text").to_pylist():
                size, found = _values(model, table, text)
                n.append(size)
                best.append(max((s for _, _, s in found), default=0.0))
                ev.append(evidence(model, size, [s for _, _, s in found]) if found else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(ev, pa.float64())],
                ["toxic", "n", "best", "evidence"])

    return train.mapInArrow(task, "toxic int, n long, best double, evidence double")


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a weighted logistic curve, by damped Newton steps."""
    def loss(v):
        z = v[0] + v[1] * x
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + 5e-3 * (v * v).sum())

    v = np.zeros(2)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(v[0] + v[1] * x, -30, 30)))
        g = np.array([(w * (q - y)).sum(), (w * (q - y) * x).sum()]) + 1e-2 * v
        s = w * q * (1 - q)
        h = np.array([[s.sum() + 1e-2, (s * x).sum()], [(s * x).sum(), (s * x * x).sum() + 1e-2]])
        step, size = np.linalg.solve(h, g), 1.0
        while loss(v - size * step) > loss(v) and size > 1e-6:
            size /= 2
        v = v - size * step
        if abs(size * step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def _calibrate(model: Model, train: DataFrame) -> Model:
    clean = _stats(train, model).where((F.col("toxic") == 0) & (F.col("n") > 0)).agg(
        F.count("*").alias("d"), F.sum(F.col("n") * F.exp(-model.rate * F.col("best"))).alias("w")).first()
    if clean.d and clean.w:
        model.k = clean.d / clean.w
    width = MAX_EVIDENCE / BINS
    # One row per bin and label.
    bins = _stats(train, model).groupBy(F.floor(F.col("evidence") / width).alias("bin"), "toxic").count().collect()
    x = np.array([(r.bin + 0.5) * width if r.bin else 0.0 for r in bins])
    y = np.array([r.toxic for r in bins], float)
    w = np.array([r["count"] for r in bins], float)
    a, b = _logistic(x, y, w)
    model.offset, model.slope = float(a), float(max(b, 0.0))
    return model


NAMES = ("score", "evidence", "passages")
TYPES = ("double", "double", "array<struct<start:int,end:int,score:double>>")


def score(docs: DataFrame, model: Model, keep: tuple = ("doc_id",), text: str = "text", names: tuple = NAMES) -> DataFrame:
    """``keep`` columns with ``score``, ``evidence`` and the significant ``passages`` (word spans).

    ``names`` are the names of the three; a kept column of such a name is replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    keep = [c for c in keep if c.lower() not in {n.lower() for n in names}]
    (body,) = private([*keep, *names], "text")
    rows = docs.select(*keep, F.col(text).alias(body))
    out = StructType([*rows.drop(body).schema.fields, *StructType.fromDDL(", ".join(map(" ".join, zip(names, TYPES)))).fields])
    arrow = to_arrow_schema(out)
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))  # plain values, at most UNITS entries

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        table = _Scores(m.scores)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                prob, ev, spans = [], [], []
                for t in batch.column(body).to_pylist():
                    n, found = _values(m, table, t)
                    e = evidence(m, n, [s for _, _, s in found]) if found else 0.0
                    ev.append(e)
                    prob.append(1 / (1 + math.exp(-max(-30.0, min(30.0, m.offset + m.slope * e)))))
                    spans.append([{"start": a, "end": b, "score": s} for a, b, s in found
                                  if m.k * n * math.exp(-m.rate * s) <= PASSAGE])
                cols = dict(zip(names, (prob, ev, spans)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[f.name], f.type) if f.name in cols else batch.column(f.name) for f in arrow], schema=arrow)

    return rows.mapInArrow(task, out)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, evidence`` for every document."""
    scored = score(docs, fit(docs, labels, rows))
    return scored.select("doc_id", (F.pmod(id_crc(), F.lit(3)) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"), "evidence")
