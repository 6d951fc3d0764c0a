"""Rows to key-value cells (R1-R5, F4, F5) and the total sort (O1).

A cell is ``(rowkey, family, qualifier, value)``, all text, no nulls.  The
reshape is ``unpivot`` (one ``Expand`` node, narrow, no shuffle).  The total
order is a range exchange followed by a sort inside each partition:
partitions hold consecutive, non-overlapping runs of the cell order, so
files written from them are internally sorted and do not overlap.  Unique
row keys are range-sorted as wide rows (each key moves once); cells whose
keys may repeat are range-sorted on the cell key and the head and hash of
the value, which splits a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.functions.columns import text_or_empty

# Fixed value: the one column family every cell is written to.
FAMILY = "cf"
# Fixed value: the column the all-columns writer leaves out.
SKIPPED_COLUMN = "main"
# Characters of a value that take part in the order of repeated cells.
VALUE_HEAD = 64


def cell_columns(
    df: DataFrame, key: str, columns: Sequence[str] | None = None,
    keep_key: bool = False, drop: Iterable[str] = (),
) -> list[str]:
    """Qualifiers in byte order: ``columns`` (default all), minus ``drop``,
    with the key column only when ``keep_key``."""
    drop = set(drop)
    names = list(columns) if columns is not None else list(df.columns)
    if not keep_key:
        drop.add(key)
    elif key not in names:
        names.append(key)
    return sorted((c for c in names if c not in drop), key=lambda s: s.encode("utf-8"))


def as_text(df: DataFrame, columns: Sequence[str], overrides: dict | None = None) -> DataFrame:
    """Select ``columns`` as text with null -> ``""`` (P2 on a whole row)."""
    overrides = overrides or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        overrides[c].alias(c) if c in overrides else text_or_empty(F.col(c), types[c]).alias(c)
        for c in columns
    ])


def to_cells(
    df: DataFrame, key: str = "rowkey", columns: Sequence[str] | None = None,
    keep_key: bool = False, drop: Iterable[str] = (), family: str = FAMILY,
    out_key: str = "rowkey",
) -> DataFrame:
    """Wide rows -> cells.

    ``keep_key=False, drop=()``: every column but the key (R1b, F5).
    ``keep_key=True``: the key is also a cell (R1c).
    ``keep_key=True, drop=("main",)``: the all-columns writer (R1a, F4).
    """
    quals = cell_columns(df, key, columns, keep_key, drop)
    text = as_text(df, [key] + [q for q in quals if q != key] if keep_key else [key] + quals)
    if keep_key:
        text = text.withColumn("_key", F.col(key))
        ids = "_key"
    else:
        ids = key
    cells = text.unpivot([ids], quals, "qualifier", "value")
    return cells.select(F.col(ids).alias(out_key), F.lit(family).alias("family"), "qualifier", "value")


def sort_cells(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Total order by ``(rowkey, family, qualifier)`` in byte order (O1).

    Cells of one key follow by the head of their value and its hash, so one
    row key repeated on many rows (a hot key) spreads over partitions instead
    of filling one, while the range key, which is sampled to the driver, stays
    short however long the values are.  Partitions hold consecutive,
    non-overlapping runs of that order.
    """
    n = partitions or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["rowkey", "family", "qualifier", F.substring("value", 1, VALUE_HEAD), F.xxhash64("value")]
    return cells.repartitionByRange(n, *order).sortWithinPartitions(*order)


def sorted_cells(
    df: DataFrame, key: str = "rowkey", columns: Sequence[str] | None = None,
    keep_key: bool = False, drop: Iterable[str] = (), family: str = FAMILY,
    partitions: int | None = None, keys_unique: bool = False,
) -> DataFrame:
    """Cells in total order, sorting the wide rows before the reshape.

    With ``keys_unique`` (each row key on one row, as after
    ``sequence_key``), the wide rows are range-sorted by key and then
    reshaped: each key moves once instead of once per cell, and ``unpivot``
    emits each row's cells in qualifier order right after one another, so
    the result is already in total order.  Otherwise the cells are sorted
    (``sort_cells``), which also splits a row key repeated on many rows.
    """
    if not keys_unique:
        # Repeated keys: sort the cells themselves, so that a key on many rows
        # can be split between partitions.
        return sort_cells(to_cells(df, key, columns, keep_key, drop, family), partitions)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = df.repartitionByRange(n, key).sortWithinPartitions(key)
    return to_cells(wide, key, columns, keep_key, drop, family)


def with_order(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Add ``pos``: the 1-based position in the total order (O1 made visible
    to an order-insensitive comparison).

    Distributed: range-sort, number rows inside each partition with
    ``monotonically_increasing_id`` and add the row counts of all earlier
    partitions.  The count table has one row per partition (the bound that
    allows its broadcast); the numbered data is written once to the shared
    folder so both uses see the same ids.
    """
    from pyspark.sql import Window

    from cellsmith.session import materialize

    ranked = materialize(
        sort_cells(cells, partitions)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "order",
    ).withColumn("_pid", F.shiftright("_mid", 33))
    stats = ranked.groupBy("_pid").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = ranked.join(F.broadcast(stats), "_pid")
    pos = (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long")
    return out.select(*cells.columns, pos.alias("pos"))
