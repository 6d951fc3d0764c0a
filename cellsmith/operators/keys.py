"""Unique keys: keep-first duplicate removal, ordinals per key, latest per key
(G2-G5).

All of them are skew-safe at any scale:

* ``dedup_keep_first`` and ``latest_per_key`` are aggregates (``min``/``max``
  of a struct that starts with the ordering columns).  Spark combines them
  map-side, so a hot key costs one row per map task in the shuffle, never a
  whole group in one task.
* ``sequence_key`` numbers rows within a base key in a fixed order, over
  ranges of ``(base, order...)`` with a carry for keys that a range's edge cuts
  (``ranges.number_ranges``): one path and one exchange for all keys, and a hot
  key spreads over as many tasks as it fills.  ``unique_sequence_key`` keeps the
  first row of each duplicate group before.  ``ranges.ordered_keys`` does both
  and the final order in one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsmith.operators.ranges import number_ranges
from cellsmith.session import materialize


def _pick(df: DataFrame, best, keys: list[str], order_by: list[str]) -> DataFrame:
    """Per key the row of the least or greatest (``best``) struct led by the
    order columns.  Maps have no order, so they are compared as entries in key order."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    maps = [c for c in rest if isinstance(df.schema[c].dataType, T.MapType)]
    packed = F.struct(*order_by, *[
        F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(best(packed).alias("_row"))
    return picked.select(*keys, *[
        (F.map_from_entries(F.col("_row")[c]) if c in maps else F.col("_row")[c]).alias(c) for c in order_by + rest
    ]).select(*df.columns)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row by ``order_by`` of each ``keys`` group.

    ``order_by`` must be a total order within a group for a deterministic
    result.  Runs as an aggregate with map-side combine.
    """
    return _pick(df, F.min, list(keys), list(order_by))


def latest_per_key(df: DataFrame, key: Sequence[str] | str, recency: Sequence[str] | str,
                   parts: int | None = None) -> DataFrame:
    """Keep the newest row by ``recency`` per key (G5, a key overwrite).

    ``parts`` deals the rows by key into that many partitions first, which bounds the rows a task
    sorts; for keys that are on a few rows each."""
    keys = [key] if isinstance(key, str) else list(key)
    if parts:
        df = df.repartition(parts, *keys)
    recency = [recency] if isinstance(recency, str) else list(recency)
    return _pick(df, F.max, keys, recency)


def sequence_number(df: DataFrame, base: str, order_by: Sequence[str], out: str = "seq", parts: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of each row within its ``base`` key,
    ordered by ``order_by`` (which must be unique within a key)."""
    return number_ranges(df, base, order_by, out, parts)


def unique_sequence_number(df: DataFrame, base: str, dedup_keys: Sequence[str], order_by: Sequence[str],
                           out: str = "seq", parts: int | None = None) -> DataFrame:
    """Keep-first on ``(base, *dedup_keys)`` by ``order_by``, then the ordinal per ``base`` (G2 followed by G3)."""
    order_by = list(order_by)
    first = Window.partitionBy(base, *dedup_keys).orderBy(*order_by)
    # Spark keeps one row a group on each side of this exchange (WindowGroupLimit).
    kept = df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(*df.columns)
    # The ranges read the rows three times.
    return number_ranges(materialize(kept, "kept"), base, order_by, out, parts)


def sequence_key(df: DataFrame, base: str, order_by: Sequence[str], out: str = "rowkey", sep: str = "",
                 parts: int | None = None) -> DataFrame:
    """Row key = ``base + sep + ordinal`` (G3 with ``sep=""``, G4 with ``"_"``).

    The ordinal is unpadded text, as in the reference (``_10`` sorts before
    ``_2``).  Replaces ``base`` by ``out`` when the names differ.
    """
    return _with_key(sequence_number(df, base, order_by, "_seq", parts), df.columns, base, out, sep)


def unique_sequence_key(df: DataFrame, base: str, dedup_keys: Sequence[str], order_by: Sequence[str],
                        out: str = "rowkey", sep: str = "", parts: int | None = None) -> DataFrame:
    """Keep-first on ``(base, *dedup_keys)``, then ``base + sep + ordinal`` (G2 + G3)."""
    numbered = unique_sequence_number(df, base, dedup_keys, order_by, "_seq", parts)
    return _with_key(numbered, df.columns, base, out, sep)


def _with_key(numbered: DataFrame, columns, base: str, out: str, sep: str) -> DataFrame:
    key = F.concat(F.col(base), F.lit(sep), F.col("_seq").cast("string"))
    cols = [c for c in columns if c not in (base, out)]
    return numbered.select(key.alias(out), *cols)
