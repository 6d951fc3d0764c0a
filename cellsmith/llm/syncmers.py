"""Document fingerprints from closed syncmers.

A k-mer of ``K`` code points is an anchor when the least hash among its inner
``S``-mers is that of the first or the last one.  Whether it is one depends
on the k-mer alone, so equal passages have equal anchors wherever they stand.
The fingerprint keeps, of all anchors of the whole text, those with the least
hashes (a minwise sketch): one in ``SHARE``, and ``SIZE`` at least, so it grows
with the text and a passage of a long text keeps anchors of its own.  Each is written
as 8 hex digits of hash and 8 of its first position.  A text shorter than ``K`` is one anchor; an empty one has none.

Likeness: among the least hashes of both fingerprints together, as many as the
smaller of the two that may have left anchors out keeps, the anchors that both have and whose position shift agrees with the most common shift
(within ``SHIFT`` or a fiftieth of the length) give a Jaccard share ``j``;
the likeness is ``2 j / (1 + j)``, the share of anchors the two have in common.

The edited text joins two texts, and its anchors are those inside either part
plus those across the seam, so each text is hashed once.

To meet the next document, ids are cut into ranges at approximate quantiles
(a bounded number of values); the first document of the next range joins each
range, and a task reads a range in order.

Cases: null text is empty; a null id comes first; equal ids are ordered by
text; the only document is its own next; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import arrow_schema, mix, shuffle_parts

K, S, SIZE, SHARE, SHIFT = 12, 5, 96, 32, 16
_M = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _roll(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all S-mers and K-mers (polynomials in doubling steps)."""
    h1 = c.astype(np.uint64) + np.uint64(1)
    power = lambda n: np.uint64(pow(_M, n, 1 << 64))
    h2 = h1[:-1] * power(1) + h1[1:]
    h4 = h2[:-2] * power(2) + h2[2:]
    h5 = h4[:-1] * power(1) + h1[4:]
    h8 = h4[:-4] * power(4) + h4[4:]
    h12 = h8[:-4] * power(4) + h4[8:]
    return mix(h5), mix(h12)


def anchors(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash32, position)`` of all anchors of a text's code points."""
    if len(c) < K:
        if not len(c):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        x = len(c)
        for v in c.tolist():
            x = (x * _M + v + 1) & _WORD
        return (mix(np.array([x], np.uint64)) >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)
    inner, whole = _roll(c)
    w = K - S + 1  # 8 inner substrings
    m = np.minimum(inner[:-1], inner[1:])
    m = np.minimum(m[:-2], m[2:])
    m = np.minimum(m[:-4], m[4:])
    at = np.flatnonzero((inner[: len(m)] == m) | (inner[w - 1:] == m))
    return (whole[at] >> np.uint64(32)).astype(np.uint32), at


def edited_anchors(a: np.ndarray, own: tuple, b: np.ndarray, nxt: tuple, keep: int, take: int) -> tuple:
    """Anchors of ``a[:keep] + b[:take]`` from those of ``a`` and ``b``."""
    if keep + take < K or len(a) < K or len(b) < K:
        return anchors(np.concatenate([a[:keep], b[:take]]))
    i = own[1] + K <= keep
    j = nxt[1] + K <= take
    lo = max(0, keep - K + 1)
    seam = np.concatenate([a[lo:keep], b[: min(take, K - 1)]])
    mid = anchors(seam) if len(seam) >= K else (own[0][:0], own[1][:0])
    return (np.concatenate([own[0][i], mid[0], nxt[0][j]]), np.concatenate([own[1][i], mid[1] + lo, nxt[1][j] + keep]))


def sketch(found: tuple, size: int = SIZE, share: int = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """The least hashes, one in ``share`` of the anchors and ``size`` at least, with their first positions."""
    h, at = found
    size = max(size, len(h) // share)
    if len(h) > 8 * size:  # the least hashes are among the least entries, repeats aside
        cut = np.partition(h, 4 * size)[4 * size]
        few = h <= cut
        if len(np.unique(h[few])) >= size:
            h, at = h[few], at[few]
    u, first = np.unique(h, return_index=True)
    return u[:size], at[first[:size]]


def to_text(s: tuple) -> str:
    return np.stack([s[0].astype(">u4"), s[1].astype(">u4")], 1).tobytes().hex()


def from_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(bytes.fromhex(text), ">u4").reshape(-1, 2)
    return pairs[:, 0].astype(np.uint32), pairs[:, 1].astype(np.int64)


def likeness(x: tuple, y: tuple, size: int = SIZE) -> float:
    if not len(x[0]) or not len(y[0]):
        return float(len(x[0]) == len(y[0]))
    both = np.union1d(x[0], y[0])
    cut = [len(s[0]) for s in (x, y) if len(s[0]) >= size]
    if cut:
        both = both[:min(cut)]
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    ok = x[0][i] <= both[-1]
    shift = np.sort(x[1][i[ok]] - y[1][j[ok]])
    if not len(shift):
        return 0.0
    room = max(SHIFT, int(max(x[1].max(), y[1].max())) // 50)
    hits = int((np.searchsorted(shift, shift + room, "right") - np.arange(len(shift))).max())
    share = hits / len(both)
    return 2 * share / (1 + share)


def ranges(docs: DataFrame, doc_id: str, parts: int) -> list:
    """At most ``parts`` ascending cut points of the ids."""
    share = [i / parts for i in range(1, parts)]
    got = docs.agg(F.percentile_approx(doc_id, share or [0.5], 10_000).alias("q")).first().q
    return sorted(set(got or []))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of every document and of its edited text, with both likenesses."""
    spark = docs.sparkSession
    n = shuffle_parts(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = np.array(ranges(rows, "doc_id", 8 * n), np.int64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy(np.int64), "right") + 1
        return pd.Series(out)

    rows = rows.withColumn("part", part("doc_id")).withColumn("tail", F.lit(0))
    # One row per range: at most 8 * n + 1.
    firsts = sorted((r.part, r.first.doc_id) for r in rows.groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id")).alias("first")).collect())
    ends = [(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)]
    heads = spark.createDataFrame(ends, "_part int, _id long")
    tails = rows.select("doc_id", "text").join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_id")))
    tails = tails.groupBy("doc_id", "_part").agg(F.min("text").alias("text")).select(
        "doc_id", "text", F.col("_part").alias("part"), F.lit(1).alias("tail"))
    ordered = rows.unionByName(tails).repartition(n, "part").sortWithinPartitions(
        "part", "tail", F.col("doc_id").asc_nulls_first(), "text")
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    arrow = arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out = None, [[] for _ in arrow]
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                cut = batch.slice(k, 256)
                for row in zip(*(cut.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail"))):
                    c = code_points(row[1])
                    found = anchors(c)
                    now = (row, c, found, sketch(found))
                    if last is not None and last[0][2] == row[2]:
                        for col, v in zip(out, _finish(last, now)):
                            col.append(v)
                    last = None if row[3] else now
                if len(out[0]) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, arrow)], schema=arrow)
                    out = [[] for _ in arrow]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, arrow)], schema=arrow)

    return ordered.mapInArrow(task, schema)


def _finish(one: tuple, two: tuple) -> tuple:
    (doc_id, text, _, _), a, own, mine = one
    (_, after, _, _), b, nxt, theirs = two
    keep, take = len(a) - len(a) // 2, min(len(a) // 2, len(b))
    edited = sketch(edited_anchors(a, own, b, nxt, keep, take))
    digest = hashlib.sha256((text[:keep] + after[:take]).encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(a), digest, to_text(mine), to_text(edited), likeness(mine, edited), likeness(mine, theirs))
