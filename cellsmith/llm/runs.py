"""Periodic runs of words: multi-scale minimizers, with lag scans for short periods.

A run is a stretch of words of least period ``q``, at least ``max(LEAST, 2 q)`` words
long, that no neighbouring word extends.  All runs of a text are found, none is
guessed: what is found by hashes is compared word by word.

Periods up to ``SCANNED`` are found by comparing the words with the words
``q`` places on.  Longer periods are taken by scales ``P <= q < 2 P``.  A
scale hashes every ``P / 4`` words and takes the least hash of every window that
fits into ``P`` words.  A run of period ``q`` holds such a window twice, ``q`` words apart, so
its minima are the same: each pair of equal minima ``P`` to ``2 P`` apart
is a seed, which is extended to both sides by binary search over prefix hashes.

Stretches that are periodic within half their length would give too many
equal minima, so they are no candidates; the rest of one value lie more than
``P / 8`` apart, which bounds the partners of each.  A run whose every window is such a
stretch has halves that lie in two touching runs of one smaller period; its
periods follow from where those two match, and are added as seeds.

Of stretches with the same ends the least period counts.  Texts are handled
in blocks of about ``BLOCK`` bytes or one text, with a separator between texts that
equals no word.

Cases: null, empty and wordless texts have no runs and collapse to an empty
text; long texts are handled whole; repeated rows give repeated rows; null ids stay null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import mix

LEAST, SCANNED, BLOCK = 12, 48, 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
NONE = np.zeros(0, np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Hashes:
    """Prefix hashes of a sequence: hash of any stretch, and how far two places agree."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n, self.back = n, _powers(_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n + 1)[:n], out=self.sums[1:])

    def of(self, i: np.ndarray, size) -> np.ndarray:
        return (self.sums[i + size] - self.sums[i]) * self.back[i]

    def ahead(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """How many words from ``i`` and from ``j > i`` on agree, ``most`` at most."""
        got, step = np.zeros(len(i), np.int64), 1 << max(0, int(most).bit_length() - 1)
        while step:
            fits = j + got + step <= self.n
            at = np.flatnonzero(fits)
            a, b = i[at] + got[at], j[at] + got[at]
            got[at[self.of(a, step) == self.of(b, step)]] += step
            step >>= 1
        return got

    def behind(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """How many words before ``i`` and before ``j > i`` agree, ``most`` at most."""
        got, step = np.zeros(len(i), np.int64), 1 << max(0, int(most).bit_length() - 1)
        while step:
            at = np.flatnonzero(i - got - step >= 0)
            a, b = i[at] - got[at] - step, j[at] - got[at] - step
            got[at[self.of(a, step) == self.of(b, step)]] += step
            step >>= 1
        return got


def scan_lag(ids: np.ndarray, q: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch of period ``q`` and enough length."""
    same = np.flatnonzero(ids[q:] == ids[:-q])
    if not len(same):
        return NONE, NONE
    cut = np.flatnonzero(np.diff(same) > 1)
    first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
    keep = last + 1 - first + q >= max(least, 2 * q)
    return first[keep], last[keep] + 1 + q


def minima(h: np.ndarray, width: int) -> np.ndarray:
    """Places that are the first least value of some window of ``width`` values."""
    at, w = np.arange(len(h)), 1
    while w < width:  # ``at[i]``: the place of the least value of ``h[i:i + w]``
        step = min(w, width - w)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(h[b] < h[a], b, a)
        w += step
    return np.unique(at)


def seeds(hashes: Hashes, size: int, found: list, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of equal minima ``scale`` to ``2 scale`` apart in the first ``size`` words."""
    k = scale // 4
    width = scale - k + 1
    if size < scale + 1:
        return NONE, NONE
    h = hashes.of(np.arange(size - k + 1), k)
    periodic = np.zeros(size + 1, np.int64)
    for start, end, q in found:
        use = (q <= k // 2) & (end <= size) & (end - start >= k)
        np.add.at(periodic, start[use], 1)
        np.add.at(periodic, end[use] - k + 1, -1)
    out = np.cumsum(periodic)[: len(h)] > 0
    h[out] = np.uint64(0xFFFFFFFFFFFFFFFF)
    at = minima(h, width)
    at = at[~out[at]]
    order = np.lexsort((at, h[at]))
    at = at[order]
    value = h[at]
    lo, hi = [], []
    step = 1
    while step < len(at):  # the next, the second next ... of the same value, as long as any is near enough
        far = at[step:] - at[:-step]
        same = (value[step:] == value[:-step]) & (far < 2 * scale)
        if not same.any():
            break
        use = same & (far >= scale)
        lo.append(at[:-step][use])
        hi.append(far[use])
        step += 1
    return (np.concatenate(lo), np.concatenate(hi)) if lo else (NONE, NONE)


def touching(hashes: Hashes, found: list, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds from neighbouring runs of one period that touch: periods ``scale`` to ``2 scale``."""
    start, end, period = (np.concatenate([f[i] for f in found]) for i in range(3))
    use = (period <= scale // 8) & (end - start >= scale)
    start, end, period = start[use], end[use], period[use]
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    lo, far = [], []
    for i in np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1])).tolist():
        b1, e1, b2, e2, p = int(start[i]), int(end[i]), int(start[i + 1]), int(end[i + 1]), int(period[i])
        turn = np.flatnonzero(hashes.of(b1 + np.arange(p), p) == hashes.of(np.array([b2]), p))
        if len(turn):
            q = (b2 - b1 - int(turn[0])) % p
            q += -(-(scale - q) // p) * p
            q = np.arange(q, min(e1 - b1, e2 - b2, (e2 - b1) // 2, 2 * scale - 1) + 1, p)
            lo.append(np.maximum(b1, b2 - q))
            far.append(q)
    return (np.concatenate(lo), np.concatenate(far)) if lo else (NONE, NONE)


def stretches(ids: np.ndarray, hashes: Hashes, at: np.ndarray, far: np.ndarray, longest: int) -> tuple:
    """``(start, end, period)`` of the seeds that lie in a stretch of two periods, checked word by word."""
    back = hashes.behind(at, at + far, longest)
    start, end = at - back, at + far + hashes.ahead(at, at + far, longest)
    keep = end - start >= 2 * far
    got = sorted(set(zip(start[keep].tolist(), end[keep].tolist(), far[keep].tolist())))
    out = []
    for a, b, q in got:
        if np.array_equal(ids[a: b - q], ids[a + q: b]):
            out.append((a, b, q))
        else:  # two stretches of one hash: look at the words themselves
            out += [(a + x, a + y, q) for x, y in zip(*(z.tolist() for z in scan_lag(ids[a: b], q)))]
    return tuple(np.array(sorted(set(out)), np.int64).reshape(-1, 3).T)


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST, scanned: int = SCANNED) -> np.ndarray:
    """Rows ``(start, end, period)`` of all runs of a sequence of texts.

    ``ids`` holds the words of the texts, longest text first, each followed by a
    separator of its own; ``sizes`` are their numbers of words."""
    ends = np.cumsum(sizes + 1)
    reach = lambda n: int(ends[k - 1]) if (k := int(np.searchsorted(-sizes, -n, "right"))) else 0
    longest = int(sizes[0]) if len(sizes) else 0
    found = [(NONE, NONE, NONE)]
    for q in range(1, scanned + 1):
        n = reach(max(least, 2 * q))
        if not n:
            break
        start, end = scan_lag(ids[:n], q, least)
        found.append((start, end, np.full(len(start), q)))
    scale, hashes = scanned + 1, None
    while 2 * scale <= longest:
        n = reach(2 * scale)
        hashes = hashes or Hashes(ids[:n])
        one, two = seeds(hashes, n, found, scale), touching(hashes, found, scale)
        at, far = (np.concatenate(x) for x in zip(one, two))
        if len(at):
            found.append(stretches(ids, hashes, at, far, longest))
        scale *= 2
    rows = np.stack([np.concatenate([f[i] for f in found]) for i in range(3)], 1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):  # of equal ends the least period
        rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period; ``runs`` are ``(start, length, period)``."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def runs_of_texts(texts: list[bytes], least: int = LEAST, scanned: int = SCANNED) -> list[tuple[list, bytes]]:
    """``(runs, collapsed text)`` of each text; runs are ``(start, length, period)`` by start and period."""
    words = [t.split() for t in texts]  # bytes: splits at 0x20 and 0x09 to 0x0D alone
    order = sorted(range(len(texts)), key=lambda i: -len(words[i]))
    number: dict[bytes, int] = {}
    ids, sizes = [], np.array([len(words[i]) for i in order], np.int64)
    for i in order:
        ids += [number.setdefault(w, len(number)) for w in words[i]]
        ids.append(-1 - i)
    rows = find_runs(np.array(ids, np.int64), sizes, least, scanned)
    first = np.r_[0, np.cumsum(sizes + 1)[:-1]] if len(sizes) else NONE
    runs: list[list] = [[] for _ in texts]
    for (start, end, period), k in zip(rows.tolist(), (np.searchsorted(first, rows[:, 0], "right") - 1).tolist()):
        runs[order[k]].append((start - int(first[k]), end - start, period))
    return [(r, b" ".join(collapse(w, r))) for r, w in zip(runs, words)]


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows of at most about ``limit`` bytes, or of one row, as bytes."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, i = np.cumsum(sizes), 0
    while i < len(texts):
        base = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield i, [x or b"" for x in texts.slice(i, j - i).cast(pa.binary()).to_pylist()]
        i = j


def find(docs: DataFrame, least: int = LEAST, scanned: int = SCANNED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` per row: all runs ``(start, length, period)``, and the text without their repeats."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, texts in blocks(batch.column("text")):
                got = runs_of_texts(texts, least, scanned)
                runs = pa.array([[{"start": a, "length": n, "period": q} for a, n, q in r] for r, _ in got], pa.list_(RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, len(texts)), runs, pa.array([c for _, c in got], pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(task, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def edited(text: bytes, crc: int) -> bytes:
    """The text whose words from ``a`` on repeat with period ``p``, both from the id's CRC; others as they are."""
    if crc % 10:
        return text
    words, g = text.split(), crc // 10
    n = len(words)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + (words[a: a + p] * (-(-(n - a) // p)))[: n - a])


def with_planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the query's planted repeats; a null id counts as the empty text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, texts in blocks(batch.column("text")):
                ids = batch.column("doc_id").slice(i, len(texts))
                new = [edited(t, zlib.crc32(b"" if d is None else str(d).encode())) for t, d in zip(texts, ids.to_pylist())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(new, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, text string")


def digest(docs: DataFrame) -> DataFrame:
    """The runs of the planted texts as one row per document: count, longest run, and digests."""
    rows = find(with_planted(docs))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("far"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    out = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("best.far"), F.col("best.period")
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
                      F.expr("(-best.far * 1000) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
