"""Ranges on split points: placement, carries over cut keys, ordered keys, text order of ordinals."""

import random

import pytest
from pyspark.sql import functions as F

from cellsmith.operators import ranges as R


@pytest.mark.parametrize("size", [1, 2, 9, 10, 11, 99, 100, 101, 1234])
def test_text_place(size):
    assert [R.text_place(k, size) for k in range(size)] == sorted(map(str, range(size)))


def test_range_of_counts_the_points_at_or_below(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(6)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, n long")
    points = [{}, {"k": "a", "n": 2}, {"k": "a", "n": 4}, {"k": "b"}, {"k": "c", "n": 5}]
    low = lambda k, n: (k is not None, k or "", n is not None, n or 0)
    want = [sum(low(p.get("k"), p.get("n")) <= low(*r) for p in points) for r in rows]
    got = [r[2] for r in df.select("k", "n", R.range_of(df, ["k", "n"], points)).collect()]
    assert got == want
    placed = R.place(df, R.range_of(df, ["k", "n"], points), 6)
    assert all(r._range == r.p for r in placed.select("_range", F.spark_partition_id().alias("p")).collect())


def test_split_points_are_quantiles_of_all_rows(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("n"))
    points = [p["n"] for p in R.split_points(df, ["n"], 8)]
    assert points == sorted(points) and len(points) == 7
    assert all(abs(p - 2500 * (i + 1)) < 1500 for i, p in enumerate(points))
    assert R.split_points(df.limit(0), ["n"], 8) == [] and R.split_points(df, ["n"], 1) == []


def test_keys_cut_by_many_points(spark):
    """A key over several ranges, a null key among them, is numbered through."""
    rows = [(k, i) for k, n in ((None, 40), ("a", 3), ("hot", 200), ("z", 1)) for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "base string, i long")
    points = [{"i": 10}, {"i": 30}, {"base": "hot", "i": 5}, {"base": "hot", "i": 77}, {"base": "hot", "i": 199}, {"base": "z"}]
    got = R.number_ranges(df, "base", ["i"], "seq", points=points).collect()
    assert len(got) == len(rows) and all(r.seq == r.i for r in got)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_ordered_keys(spark, parts):
    rnd = random.Random(parts)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(60):02d}", rnd.randrange(25), i) for i in range(4000)]
    rows += [("hot", 1, 5000 + i) for i in range(2000)]  # a third of all rows repeats one row
    df = spark.createDataFrame(rows, "base string, peer long, i long")
    for dedup in ([], ["peer"]):
        out = R.ordered_keys(df, "base", ["i"], dedup, "_", parts=parts)
        got = out.collect()
        want, seen, n = {}, set(), {}
        for base, peer, i in sorted(rows, key=lambda r: r[2]):
            if dedup and (base, peer) in seen:
                continue
            seen.add((base, peer))
            want[i] = f"{base}_{n.get(base, 0)}"
            n[base] = n.get(base, 0) + 1
        assert {r.i: r.rowkey for r in got} == want and len(got) == len(want)
        keys = [r.rowkey for r in got]
        assert keys == sorted(keys)  # rows come range by range
    if parts == 40:  # without keep-first the hot key spreads over many ranges
        held = R.ordered_keys(df, "base", ["i"], sep="_", parts=parts).where("rowkey like 'hot%'")
        sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 10 and max(sizes) < 1000
    assert R.ordered_keys(df.limit(0), "base", ["i"], ["peer"], parts=parts).count() == 0
