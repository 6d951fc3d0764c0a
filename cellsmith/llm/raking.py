"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed over the cells source x language x topic.  Raking
scales the cells in turn until their source, language and topic sums match
the target shares: until no sum was off by more than ``TOLERANCE`` of all
tokens in a whole sweep.  Targets that no scaling can meet (a margin's tokens all in
cells that another margin gives none) never get there; after ``SWEEPS``
sweeps a warning states the residual, and the last sweep's weights hold.  A cell's documents are sampled with probability
``min(1, scale * ratio)``, where ``ratio`` is the cell's raked over present
tokens and ``scale`` makes the expected sample ``KEEP`` of all tokens.  Kept
documents carry the ``weight`` ``ratio / probability``, which is one common
number but for cells kept whole; weighted, the sample has the raked margins.
No document is repeated.  The draw is a hash of the id, the same in every run.

Targets default to tempered shares, ``share ** temper`` renormalised: small
sources, languages and topics gain and large ones lose.

Cases: null source or language is a group of its own (written as null), null
and empty texts have 0 tokens and go with their cell; a cell without tokens
has ratio 1;
null ids are drawn as the empty text; repeated ids share a draw; an empty
table gives an empty result.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import private
from cellsmith.session import materialize

DIMS = ("source", "lang", "topic")
TEMPER, KEEP, SWEEPS, TOLERANCE, SEED = 0.7, 0.8, 200, 1e-10, "mix-1"
MAX_CELLS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"\*\*\*|&&&|###|%%%"


def with_topic(docs: DataFrame, text: str = "text", names: tuple = ("topic", "n_tokens"), given: str | None = None) -> DataFrame:
    """Add ``topic`` (the kind of text: table, symbols, capitals, prose) and ``n_tokens`` (words).

    ``given`` names a column of known topics; the kind of text then stands in where it is null.
    ``names`` are the names of the two; a column of such a name is replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    kind = (F.when(t.contains(" | "), "table").when(t.rlike(SYMBOLS), "symbols")
             .when((t == F.upper(t)) & (t != F.lower(t)), "capitals").otherwise("prose"))
    if given:
        kind = F.coalesce(F.col(given).cast("string"), kind)
    return docs.withColumns(dict(zip(names, (kind, F.regexp_count(t, F.lit(WORD)).cast("long")))))


def tempered(shares: dict, temper: float) -> dict:
    powered = {k: v ** temper if v else 0.0 for k, v in shares.items()}
    total = sum(powered.values()) or 1.0
    return {k: v / total for k, v in powered.items()}


def unmet(residual: float, sweeps: int) -> None:
    warnings.warn(f"raking left a margin off by {residual:.2g} of all tokens after {sweeps} sweeps", stacklevel=3)


def rake_local(cells: list[tuple], dims: int, targets: list[dict] | None, temper: float, sweeps: int,
               tolerance: float = TOLERANCE) -> np.ndarray:
    """Raked over present tokens per cell; ``cells`` are ``(*labels, tokens)``."""
    tokens = np.array([c[dims] for c in cells], float)
    codes, goals = [], []
    for d in range(dims):
        labels = list(dict.fromkeys(c[d] for c in cells))
        number = {x: i for i, x in enumerate(labels)}
        code = np.array([number[c[d]] for c in cells], np.int64)
        sums = np.bincount(code, tokens, len(labels))
        share = dict(zip(labels, sums / max(tokens.sum(), 1)))
        goal = targets[d] if targets else tempered(share, temper)
        codes.append(code)
        goals.append(np.array([goal.get(x, 0.0) for x in labels]) * tokens.sum())
    w, total = tokens.copy(), max(tokens.sum(), 1.0)
    for _ in range(sweeps):
        residual = 0.0
        for code, goal in zip(codes, goals):
            sums = np.bincount(code, w, len(goal))
            residual = max(residual, float(np.abs(sums - goal).max(initial=0.0)) / total)
            w = w * np.divide(goal, sums, out=np.zeros_like(goal), where=sums > 0)[code]
        if residual <= tolerance:
            break
    else:
        unmet(residual, sweeps)
    return np.divide(w, tokens, out=np.ones_like(w), where=tokens > 0)


def rake_table(cells: DataFrame, dims: tuple, targets: list[dict] | None, temper: float, sweeps: int,
               tolerance: float = TOLERANCE) -> DataFrame:
    """The same raking for a cell table too large for the driver; one written table a sweep."""
    spark = cells.sparkSession
    now = materialize(cells.withColumn("_w", F.col("tokens").cast("double")), "rake")
    total = now.agg(F.sum("_w")).first()[0] or 0.0
    goals = []
    for d, dim in enumerate(dims):
        sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("_s"))
        if targets:
            given = spark.createDataFrame(list(targets[d].items()) or [(None, 0.0)], f"{dim} string, _g double")
            goal = sums.join(given, sums[dim].eqNullSafe(given[dim]), "left").select(
                sums[dim], (F.coalesce("_g", F.lit(0.0)) * total).alias("_goal"))
        else:
            powered = sums.withColumn("_p", F.when(F.col("_s") > 0, F.pow(F.col("_s") / (total or 1.0), F.lit(temper))).otherwise(0.0))
            norm = powered.agg(F.sum("_p")).first()[0] or 1.0
            goal = powered.select(dim, (F.col("_p") / norm * total).alias("_goal"))
        goals.append(materialize(goal, "goal"))
    for _ in range(sweeps):
        residual = 0.0
        for dim, goal in zip(dims, goals):
            sums = now.groupBy(dim).agg(F.sum("_w").alias("_sum"))
            factor = materialize(goal.join(sums, goal[dim].eqNullSafe(sums[dim])).select(
                goal[dim].alias("_d"), F.abs(F.col("_goal") - F.col("_sum")).alias("_off"),
                F.when(F.col("_sum") > 0, F.col("_goal") / F.col("_sum")).otherwise(0.0).alias("_f")), "factor")
            residual = max(residual, (factor.agg(F.max("_off")).first()[0] or 0.0) / (total or 1.0))
            factor = factor.drop("_off")
            now = now.join(factor, F.col(dim).eqNullSafe(F.col("_d"))).withColumn("_w", F.col("_w") * F.col("_f")).drop("_d", "_f")
        now = materialize(now, "rake")
        if residual <= tolerance:
            break
    else:
        unmet(residual, sweeps)
    return now.select(*dims, "tokens", F.when(F.col("tokens") > 0, F.col("_w") / F.col("tokens")).otherwise(1.0).alias("ratio"))


def scale_for(keep: float, total: float, kept) -> float:
    """The scale at which ``kept(scale)`` tokens, which grows with it, are ``keep * total``."""
    lo, hi = 0.0, 1.0
    while kept(hi) < keep * total and hi < 1e12:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if kept(mid) < keep * total else (lo, mid)
    return hi


def probabilities(docs: DataFrame, dims: tuple = DIMS, targets: list[dict] | None = None, temper: float = TEMPER,
                  keep: float = KEEP, sweeps: int = SWEEPS, tolerance: float = TOLERANCE,
                  max_cells: int = MAX_CELLS, n_tokens: str = "n_tokens") -> tuple[DataFrame, bool]:
    """``probability`` and ``weight`` per cell, and whether the table is within ``max_cells`` rows."""
    spark = docs.sparkSession
    cells = materialize(docs.groupBy(*dims).agg(F.sum(n_tokens).alias("tokens")), "cells")
    small = cells.limit(max_cells + 1).count() <= max_cells
    if small:
        rows = sorted((tuple(r) for r in cells.collect()), key=str)
        ratio = rake_local(rows, len(dims), targets, temper, sweeps, tolerance)
        tokens = np.array([r[-1] for r in rows], float)
        scale = scale_for(keep, tokens.sum(), lambda x: float((tokens * np.minimum(1, x * ratio)).sum()))
        raked = spark.createDataFrame([(*r[:-1], float(x)) for r, x in zip(rows, ratio)],
                                      ", ".join(f"{d} string" for d in dims) + ", ratio double")
    else:
        raked = materialize(rake_table(cells, dims, targets, temper, sweeps, tolerance), "raked")
        total = raked.agg(F.sum("tokens")).first()[0] or 0
        scale = scale_for(keep, total, lambda x: raked.agg(
            F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("ratio") * F.lit(x)))).first()[0] or 0)
    p = F.round(F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)), 6)
    weight = F.when(p > 0, F.round(F.col("ratio") / p, 4)).otherwise(F.lit(0.0))
    return raked.select(*dims, p.alias("probability"), weight.alias("weight")), small


def draw(doc_id: str = "doc_id", seed: str = SEED):
    """A uniform number in [0, 1) from the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


NAMES = ("probability", "weight", "sampled")


def mix(docs: DataFrame, dims: tuple = DIMS, doc_id: str = "doc_id", names: tuple = NAMES, **options) -> DataFrame:
    """``docs`` with ``probability``, ``weight`` and ``sampled``; ``docs`` has ``dims`` and the tokens.

    ``names`` are the names of the three; a column of such a name is replaced."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    table, small = probabilities(docs, dims, **options)
    keys = private([*docs.columns, *names], *dims)
    table = table.select(*[F.col(d).alias(k) for d, k in zip(dims, keys)], F.col("probability").alias(names[0]),
                         F.col("weight").alias(names[1]))
    table = F.broadcast(table) if small else table
    on = [F.col(d).eqNullSafe(F.col(k)) for d, k in zip(dims, keys)]
    return docs.join(table, on).drop(*keys).withColumn(names[2], draw(doc_id) < F.col(names[0]))
