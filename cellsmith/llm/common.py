"""Helpers shared by the operators: table access, grouped Arrow tasks, hashed words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def private(columns, *names: str) -> tuple[str, ...]:
    """``names`` with underscores before them until none is in ``columns`` (upper and lower case alike)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        name = "_" + name
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def id_crc(doc_id: str = "doc_id"):
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def within(rows: DataFrame, limit: int) -> bool:
    """True when ``rows`` has at most ``limit`` rows (reads no more than it needs)."""
    return rows.limit(limit + 1).count() <= limit


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def by_group(rows: DataFrame, key: str, fn: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``fn`` on each group of ``key`` (a long) as columns of Python values.

    One shuffle and one sort; groups stream through Arrow batches, so a task
    holds one group at a time.  Callers bound the size of a group.
    """
    n = shuffle_parts(rows.sparkSession)
    names = [c for c in rows.columns if c != key]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, out, held = None, [], [], 0

        def flush():
            group = {c: pa.concat_arrays([p.column(c) for p in parts]) for c in names}
            return list(fn({"key": at} | group))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                if parts and keys[a] != at:
                    out += flush()
                    parts = []
                at = keys[a]
                parts.append(batch.slice(a, b - a))
            held = len(out)
            if held >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if parts:
            out += flush()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = arrow_schema(schema)
    return rows.repartition(n, key).sortWithinPartitions(key).mapInArrow(task, schema)


# Word spans and hashes, on UTF-8 bytes.  A word is a run of bytes other than
# 0x20 and 0x09 to 0x0D; A to Z are lower-cased.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
CHUNK = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the ``n + 1`` offsets of an Arrow text column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset: col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


class Words:
    """Words of an Arrow text column: hash, byte span and per-row bounds.

    Works through the bytes in chunks that end between words, so memory
    beyond the spans themselves stays bounded for texts of any length.
    """

    def __init__(self, col: pa.Array):
        self.data, self.offsets = string_buffers(col)
        lo, hi = (int(self.offsets[0]), int(self.offsets[-1])) if len(self.offsets) else (0, 0)
        starts, ends, hashes = [], [], []
        power = None
        a = lo
        while a < hi:
            b = min(a + CHUNK, hi)
            while b < hi and not _SPACE[self.data[b]]:  # never inside a word
                nxt = np.flatnonzero(_SPACE[self.data[b: b + 4096]])
                edge = self.offsets[np.searchsorted(self.offsets, b, "left")] - b
                step = min(int(nxt[0]) if len(nxt) else 4096, int(edge), hi - b)
                if step == 0:
                    break
                b += step
            d = self.data[a:b]
            word = ~_SPACE[d]
            i, j = np.searchsorted(self.offsets, (a, b), "left")
            inner = self.offsets[i:j] - a
            prev = np.empty(b - a, bool)
            prev[0], prev[1:] = False, word[:-1]
            prev[inner[inner < b - a]] = False
            s = np.flatnonzero(word & ~prev)
            cut = np.empty(b - a, bool)
            cut[-1], cut[:-1] = True, ~word[1:] | ~prev[1:]
            e = np.flatnonzero(word & cut) + 1
            if power is None or len(power[0]) <= b - a:
                power = _powers(max(min(CHUNK, hi - lo), b - a) + 1)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(_LOWER[d] * power[0][: b - a], out=total[1:])
            hashes.append(mix((total[e] - total[s]) * power[1][s]))
            starts.append(s + a)
            ends.append(e + a)
            a = b
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.starts, self.ends, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        self.bounds = np.searchsorted(self.starts, self.offsets, "left")

    def text(self, i: int) -> str:
        """The i-th word, A to Z lower-cased."""
        raw = self.data[self.starts[i]: self.ends[i]].tobytes()
        return raw.lower().decode("utf-8", "replace")

    def joined(self, which: np.ndarray) -> str:
        """The words ``which``, A to Z lower-cased, each after one space."""
        sizes = self.ends[which] - self.starts[which] + 1
        ends = np.cumsum(sizes)
        raw = self.data[np.maximum(np.arange(ends[-1]) + np.repeat(self.starts[which] - 1 - (ends - sizes), sizes), 0)]
        raw[ends - sizes] = 0x20
        return raw.tobytes().lower().decode("utf-8", "replace")


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per row; fewer words than ``size`` make one shingle."""
    h, n = words.hash, len(words.hash)
    k = np.uint64(0xD6E8FEB86659FD93)
    roll = np.zeros(max(0, n - size + 1), np.uint64)
    for i in range(size):
        roll = roll * k + h[i: n - size + 1 + i] if len(roll) else roll
    roll = mix(roll)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= size:
            out.append(np.unique(roll[a: b - size + 1]))
        elif b > a:
            x = int(b - a)
            for w in h[a:b].tolist():
                x = (x * int(k) + w) & 0xFFFFFFFFFFFFFFFF
            out.append(mix(np.array([x], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
