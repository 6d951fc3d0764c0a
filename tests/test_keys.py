"""Keys: keep-first, ordinals, latest per key, against plain Python, with a key of a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from cellsmith.operators import keys as K


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # one key holds about a third of all rows
        base = "hot" if i % 3 == 0 else f"k{rnd.randrange(50)}"
        rows.append((base, f"p{rnd.randrange(5)}", f"t{rnd.randrange(4)}", f"id{rnd.randrange(40):03d}", i))
    return spark.createDataFrame(rows, "base string, peer string, time string, id string, pos long")


def collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def brute_unique_seq(rows):
    """Reference in plain Python: keep first by (id, pos), number per base."""
    out, groups = [], {}
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[4])):
        groups.setdefault(r[0], []).append(r)
    for base, items in groups.items():
        seen, n = set(), 0
        for r in items:
            if (r[1], r[2]) in seen:
                continue
            seen.add((r[1], r[2]))
            out.append((r[4], f"{base}{n}"))
            n += 1
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_unique_sequence_matches_brute_force(spark, skewed, parts):
    rows = [tuple(r) for r in skewed.collect()]
    got = K.unique_sequence_key(skewed, "base", ["peer", "time"], ["id", "pos"], "rowkey", "", parts=parts)
    assert collect(got, ["pos", "rowkey"]) == brute_unique_seq(rows)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_sequence_key_whatever_the_ranges(spark, skewed, parts):
    got = K.sequence_key(skewed, "base", ["id", "pos"], "rowkey", "_", parts=parts)
    keys = [r["rowkey"] for r in got.collect()]
    assert len(keys) == len(set(keys)) == skewed.count()
    # ordinals are 0..n-1 per base, in (id, pos) order
    rows = sorted(skewed.collect(), key=lambda r: (r["base"], r["id"], r["pos"]))
    expect, n = {}, {}
    for r in rows:
        expect[r["pos"]] = f"{r['base']}_{n.get(r['base'], 0)}"
        n[r["base"]] = n.get(r["base"], 0) + 1
    assert {r["pos"]: r["rowkey"] for r in got.collect()} == expect


def test_sequence_is_stable_under_repartition(spark, skewed):
    a = K.sequence_key(skewed, "base", ["id", "pos"], "rowkey", "_", parts=16)
    b = K.sequence_key(skewed.repartition(7, "peer"), "base", ["id", "pos"], "rowkey", "_", parts=16)
    assert collect(a, ["pos", "rowkey"]) == collect(b, ["pos", "rowkey"])


def test_ordinals_unpadded(spark):
    df = spark.range(11).select(F.lit("k").alias("base"), F.col("id"))
    keys = [r[0] for r in K.sequence_key(df, "base", ["id"], "rowkey", "_").orderBy("rowkey").collect()]
    assert keys[:3] == ["k_0", "k_1", "k_10"] and keys[-1] == "k_9"


def test_dedup_keep_first(spark):
    df = spark.createDataFrame(
        [("b", "p", "t", 2, "x"), ("b", "p", "t", 1, "y"), ("b", "q", "t", 3, "z")],
        "base string, peer string, time string, o int, v string")
    got = K.dedup_keep_first(df, ["base", "peer", "time"], ["o"])
    assert collect(got, ["peer", "o", "v"]) == [("p", 1, "y"), ("q", 3, "z")]
    assert got.columns == df.columns


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 5, "new"), ("b", 2, "only")], "k string, r int, v string")
    assert collect(K.latest_per_key(df, "k", "r"), ["k", "v"]) == [("a", "new"), ("b", "only")]
