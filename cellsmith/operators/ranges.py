"""Range partitions on known split points, and numbering across them.

``split_points`` takes quantiles of a uniform sample, or the caller gives
points.  The partition of a row then follows from its own columns alone
(``range_of``), so every pass over the rows agrees on it, also after a lost
executor.  ``place`` sends rows to their range with one exchange; windows per
range reuse it, because Spark knows how the rows were dealt.

``number_ranges`` numbers the rows of every key in order: a segmented prefix
count.  A key that no point cuts lies in one range and is numbered there.  Of a
key that points cut, the pieces in earlier ranges are counted and carried.  There are
at most as many pieces beyond the first as points, whatever the keys.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsmith.session import materialize

# Sampled rows a partition, and at most; the points balance ranges, results do not depend on them.
SAMPLE, MOST = 40, 200_000
# Rows of a range, where their number is known: the ranges become more, not larger, as the input grows.
ROWS = 500_000


def partitions_of(df: DataFrame, parts: int | None = None) -> int:
    return max(1, parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def partitions_for(df: DataFrame, rows: int) -> int:
    """The session's partitions, or as many as hold ``ROWS`` rows each."""
    return max(partitions_of(df), -(-rows // ROWS))


def split_points(df: DataFrame, columns: Sequence[str], parts: int) -> list[dict]:
    """``parts - 1`` quantiles of a uniform sample of ``columns``, rising, possibly repeated.

    One pass over these columns; the driver sees at most ``MOST`` rows of the sample's bounded size."""
    if parts < 2:
        return []
    size = min(MOST, max(1000, SAMPLE * parts))
    few = df.select(*columns).orderBy(F.rand(11)).limit(size).orderBy(*columns)
    rows = [json.loads(r[0]) for r in few.select(F.to_json(F.struct(*columns))).collect()]
    return [rows[len(rows) * i // parts] for i in range(1, parts)] if rows else []


def range_of(df: DataFrame, columns: Sequence[str], points: Sequence[dict]) -> Column:
    """Number of the range of a row: how many points are at or below its ``columns``.

    A binary search in a constant array; ``points`` are rising, a missing or null field is least."""
    if not points:
        return F.lit(0)
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
    table = F.from_json(F.lit(json.dumps(list(points))), T.ArrayType(kind))
    steps = [1 << k for k in reversed(range(len(points).bit_length()))]
    key, n = F.struct(*columns), len(points)

    def step(at, size):
        below = F.element_at(table, F.least(at + size, F.lit(n))) <= key
        return F.when((at + size <= n) & below, at + size).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def place(df: DataFrame, number: Column | str, parts: int, out: str = "_range") -> DataFrame:
    """Rows dealt by the range ``number``: partition ``i`` of ``parts`` holds range ``i``.  One exchange."""
    return df.withColumn(out, number if isinstance(number, Column) else F.col(number)).repartitionById(parts, out)


def carries(df: DataFrame, base: str, columns: Sequence[str], points: Sequence[dict],
            number: str = "_range") -> DataFrame | None:
    """``(base, number, carry)``: the rows of a cut key in its earlier ranges of ``columns``.

    Reads the rows of cut keys alone; at most two rows a point come back, so it may be broadcast."""
    if not points:
        return None
    # The keys of the points as a small table; a point without one stands for the null key.
    kind = T.ArrayType(T.StructType([T.StructField(base, df.schema[base].dataType)]))
    named = F.from_json(F.lit(json.dumps([{base: p[base]} if p.get(base) is not None else {} for p in points])), kind)
    keys = df.sparkSession.range(1).select(F.explode(named).alias("_p")).select(F.col("_p")[base].alias("_cut")).distinct()
    pieces = df.select(*columns).join(F.broadcast(keys), F.col(base).eqNullSafe(F.col("_cut")), "left_semi")
    pieces = pieces.withColumn(number, range_of(df, columns, points)).groupBy(base, number).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(base).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(base, number, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))


def number_ranges(df: DataFrame, base: str, order_by: Sequence[str], out: str = "seq", parts: int | None = None,
                  points: Sequence[dict] | None = None) -> DataFrame:
    """Add ``out``: the 0-based place of each row within its ``base`` by ``order_by``, however many rows a key has.

    Rows come in ranges of ``(base, order)``; one exchange, one path for all keys.  A null key is a key."""
    order_by = list(order_by)
    parts = partitions_of(df, parts)
    columns = [base, *order_by]
    points = split_points(df, columns, parts) if points is None else list(points)
    parts = len(points) + 1
    ranged = df.withColumn("_range", range_of(df, columns, points))
    inside = Window.partitionBy("_range", base).orderBy(*order_by)
    rows = ranged.repartitionById(parts, "_range").withColumn(out, F.row_number().over(inside).cast("long") - 1)
    carry = carries(df, base, columns, points)
    if carry is not None:
        carry = carry.select(F.col(base).alias("_cut"), F.col("_range").alias("_piece"), "_carry")
        on = F.col(base).eqNullSafe(F.col("_cut")) & (F.col("_range") == F.col("_piece"))
        rows = rows.join(F.broadcast(carry), on, "left").withColumn(out, F.col(out) + F.coalesce("_carry", F.lit(0)))
    return rows.select(*df.columns, out)


def text_place(k: int, size: int) -> str:
    """The ``k``-th of the numbers ``0 .. size - 1`` in the order of their text (``10`` before ``2``)."""
    if k == 0:
        return "0"
    k -= 1  # "0" is first and no other number begins with it
    at = 1
    while True:  # ``at`` and how many numbers from 1 on begin with it
        lo, hi, under = at, at, 0
        while lo < size:
            under += min(hi, size - 1) - lo + 1
            lo, hi = lo * 10, hi * 10 + 9
        if k >= under:
            k, at = k - under, at + 1
        elif k == 0:
            return str(at)
        else:
            k, at = k - 1, at * 10


def ordered_keys(df: DataFrame, base: str, order_by: Sequence[str], dedup_keys: Sequence[str] = (), sep: str = "",
                 out: str = "rowkey", parts: int | None = None, sample: DataFrame | None = None) -> DataFrame:
    """Unique row keys ``base + sep + ordinal`` in total order: keep-first, ordinal and order in one exchange.

    Rows are dealt by ranges of ``base + sep``; windows per range keep the first
    row of each ``(base, *dedup_keys)`` and number the rest, and each range is
    sorted by the finished key.  A base that fills a range or more (it holds two quantiles of the sample) is
    first made unique and numbered by itself (``number_ranges``); its
    rows then go to ranges of the ordinal's text, whose bounds follow from its size.

    ``sample`` may give other rows with ``base`` for the split points, say of a share of the input; they
    balance the ranges and decide nothing else.
    Valid when no ``base + sep`` is a prefix of another one, so that their order is the order of
    keys; callers check."""
    order_by, dedup_keys = list(order_by), list(dedup_keys)
    parts = partitions_of(df, parts)
    stem = F.concat(F.col(base), F.lit(sep)).alias("_stem")
    rows = df.select("*", stem)
    seen = (df if sample is None else sample).select(stem).where(F.col("_stem").isNotNull())
    named = [p["_stem"] for p in split_points(seen, ["_stem"], parts)]
    heavy = sorted({a for a, b in zip(named, named[1:]) if a == b})
    points = {(b, "") for b in named}
    seq = F.lit(None).cast("long")
    if heavy:
        few = F.broadcast(df.sparkSession.createDataFrame([(b,) for b in heavy], "_stem string"))
        crowd = rows.join(few, "_stem", "left_semi")
        if dedup_keys:  # Spark drops later rows of a group before this exchange already
            first = Window.partitionBy("_stem", *dedup_keys).orderBy(*order_by)
            crowd = crowd.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(*rows.columns)
        # Numbered rows are used twice: for the sizes and in the last exchange.
        crowd = materialize(number_ranges(crowd, "_stem", order_by, "_seq", parts), "crowd")
        sizes = {r[0]: r[1] for r in crowd.groupBy("_stem").count().collect()}  # a row a heavy base, fewer than points
        for b in heavy:
            n, size = named.count(b), sizes.get(b, 0)
            points |= {(b, text_place(size * i // n, size)) for i in range(1, n) if size * i // n}
        rows = rows.join(few, "_stem", "left_anti").withColumn("_seq", seq).unionByName(crowd)
    else:
        rows = rows.withColumn("_seq", seq)
    rows = rows.withColumn("_text", F.coalesce(F.col("_seq").cast("string"), F.lit("")))
    points = [{"_stem": b, "_text": t} for b, t in sorted(points, key=lambda p: (p[0].encode("utf-8"), p[1]))]
    ranged = place(rows, range_of(rows, ["_stem", "_text"], points), len(points) + 1)
    if dedup_keys:
        first = Window.partitionBy("_range", "_stem", *dedup_keys).orderBy(*order_by)
        ranged = ranged.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")
    inside = Window.partitionBy("_range", "_stem").orderBy(*order_by)
    place_ = F.coalesce("_seq", F.row_number().over(inside).cast("long") - 1)
    made = ranged.withColumn("_key", F.concat("_stem", place_.cast("string")))
    return made.select(F.col("_key").alias(out), *[c for c in df.columns if c not in (base, out)]).sortWithinPartitions(out)
