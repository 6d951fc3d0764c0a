"""Reshape, total order, staged files and publish (FIXTURES.md C, SURVEY 5.3-5.4)."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellsmith.operators import cells as CE
from cellsmith.session import scratch_path
from cellsmith.sinks import files as S


def test_to_cells_variants(spark):
    df = spark.createDataFrame([("k1", "a", None, "m")], "rowkey string, b string, a string, main string")
    skip = CE.to_cells(df, "rowkey")
    assert sorted(tuple(r) for r in skip.collect()) == [
        ("k1", "cf", "a", ""), ("k1", "cf", "b", "a"), ("k1", "cf", "main", "m")]
    named = CE.to_cells(df, "rowkey", keep_key=True, drop=["main"])
    assert sorted(r["qualifier"] for r in named.collect()) == ["a", "b", "rowkey"]
    assert CE.to_cells(df, "rowkey", keep_key=True).count() == 4


def test_sort_cells_byte_order(spark):
    keys = ["k_2", "a_0", "Z", "k_10", "a0_0"]
    df = spark.createDataFrame([(k, "cf", "q", "v") for k in keys], "rowkey string, family string, qualifier string, value string")
    got = [r["rowkey"] for r in CE.with_order(df, 3).orderBy("pos").collect()]
    assert got == ["Z", "a0_0", "a_0", "k_10", "k_2"]


def test_with_order_positions(spark):
    df = spark.range(500).select(F.format_string("r%05d", (F.col("id") * 7919) % 500).alias("rowkey"),
                                 F.lit("cf").alias("family"), F.lit("q").alias("qualifier"), F.lit("v").alias("value"))
    rows = CE.with_order(df, 5).collect()
    assert sorted(r["pos"] for r in rows) == list(range(1, 501))
    assert all(r["rowkey"] == f"r{r['pos'] - 1:05d}" for r in rows)


def _contact_cells(spark):
    from cellsmith.plans import jobs
    from cellsmith.sources import fixtures as fx
    return jobs.contacts_to_cells(fx.contacts(spark, "/root/testdata/sf0.001"))


def test_staged_files_sorted_and_disjoint(spark):
    staging = S.staging_path(scratch_path(spark, "t-stage"), "ns:t", 123)
    assert staging.endswith("/bulkload/ns/t_123")
    S.write_sorted_cells(_contact_cells(spark), staging, files=4)
    spans = []
    for f in sorted(glob.glob(os.path.join(staging.replace("file:", ""), "*.parquet"))):
        t = pq.read_table(f).to_pydict()
        pairs = list(zip(t["rowkey"], t["qualifier"]))
        if not pairs:
            continue
        enc = [(a.encode(), b.encode()) for a, b in pairs]
        assert enc == sorted(enc), f"{f} not sorted"
        spans.append((enc[0], enc[-1]))
    assert len(spans) >= 2
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    S.check_staging(spark, staging)


def test_publish_is_idempotent(spark):
    base = scratch_path(spark, "t-publish")
    cells = _contact_cells(spark)
    staging = S.write_sorted_cells(cells, f"{base}/stage", presorted=True)
    target = f"{base}/table"
    assert S.read_cells(spark, target) is None
    S.publish(spark, staging, target)
    first = sorted(tuple(r) for r in S.read_cells(spark, target).collect())
    S.publish_existing(spark, staging, target)
    assert sorted(tuple(r) for r in S.read_cells(spark, target).collect()) == first
    assert len(S.batches(spark, target)) == 2
    assert len(first) == cells.count()
    S.publish(spark, staging, target, batch=S.batches(spark, target)[0])  # a batch that is there
    assert len(S.batches(spark, target)) == 2


def test_publish_replaces_cells(spark):
    base = scratch_path(spark, "t-merge")
    schema = "rowkey string, family string, qualifier string, value string"
    a = spark.createDataFrame([("k1", "cf", "q", "old"), ("k2", "cf", "q", "keep")], schema)
    b = spark.createDataFrame([("k1", "cf", "q", "new")], schema)
    target = f"{base}/table"
    S.publish(spark, S.write_sorted_cells(a, f"{base}/a"), target)
    S.publish(spark, S.write_sorted_cells(b, f"{base}/b"), target)
    assert sorted(tuple(r) for r in S.read_cells(spark, target).collect()) == [
        ("k1", "cf", "q", "new"), ("k2", "cf", "q", "keep")]


def test_publish_rejects_repeated_cells(spark):
    base = scratch_path(spark, "t-dup")
    schema = "rowkey string, family string, qualifier string, value string"
    dup = spark.createDataFrame([("k", "cf", "q", "1"), ("k", "cf", "q", "2")], schema)
    staging = S.write_sorted_cells(dup, f"{base}/stage")
    with pytest.raises(ValueError):
        S.publish(spark, staging, f"{base}/table")


def test_upsert_keeps_newest(spark):
    target = scratch_path(spark, "t-upsert")
    schema = "k string, r long, v string"
    S.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema), target, "k", "r")
    S.upsert(spark.createDataFrame([("a", 2, "x2"), ("b", 0, "stale")], schema), target, "k", "r")
    got = sorted(tuple(r) for r in S.read_rows(spark, target, "k", "r").collect())
    assert got == [("a", 2, "x2"), ("b", 1, "y")]


def _cells(spark, rows):
    return spark.createDataFrame([(k, "cf", "q", v) for k, v in rows],
                                 "rowkey string, family string, qualifier string, value string")


def test_publish_after_interrupted_writer(spark):
    base = scratch_path(spark, "t-interrupt")
    a = _cells(spark, [("k1", "v")])
    target = f"{base}/table"
    staging = S.write_sorted_cells(a, f"{base}/a")
    S.publish(spark, staging, target)
    # data written aside, never moved in (job lost before)
    _cells(spark, [("k9", "lost")]).write.parquet(f"{target}_writing/lost")
    path = S.publish(spark, staging, target)
    assert path == S.batch_path(target, S.batches(spark, target)[-1])
    assert [tuple(r) for r in S.read_cells(spark, target).collect()] == [("k1", "cf", "q", "v")]


def test_concurrent_writers_lose_and_leak_nothing(spark):
    from concurrent.futures import ThreadPoolExecutor

    target = scratch_path(spark, "t-race")
    parts = [spark.range(i * 100, i * 100 + 100).select(
        F.col("id").cast("string").alias("k"), F.lit(i).alias("r")) for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda df: S.upsert(df, target, "k", "r"), parts))
    assert len(S.batches(spark, target)) == 6
    assert S.read_rows(spark, target, "k", "r").count() == 600


def test_upsert_with_map_columns(spark):
    target = scratch_path(spark, "t-maps")
    schema = "k string, r long, m map<string,int>"
    S.upsert(spark.createDataFrame([("a", 1, {"x": 1}), ("b", 1, None)], schema), target, "k", "r")
    S.upsert(spark.createDataFrame([("a", 2, {"y": 2, "b": 3})], schema), target, "k", "r")
    got = {r["k"]: r["m"] for r in S.read_rows(spark, target, "k", "r").collect()}
    assert got == {"a": {"y": 2, "b": 3}, "b": None}


@pytest.mark.parametrize("rows", [
    [("b", "1"), ("a", "1"), ("c", "1")],  # unsorted
    [("a", "1"), ("a", "1")],  # repeated
])
def test_unsorted_or_repeated_staging_is_refused(spark, rows):
    base = scratch_path(spark, "t-unsorted")
    _cells(spark, rows).coalesce(1).write.parquet(f"{base}/s")
    for move in (False, True):
        with pytest.raises(ValueError):
            S.publish(spark, f"{base}/s", f"{base}/t", move=move)


@pytest.mark.parametrize("second", [["c", "e"], ["d", "f"], ["b", "c"]])
def test_overlapping_files_are_refused(spark, second):
    base = scratch_path(spark, "t-overlap")
    for keys in (["a", "d"], second):
        _cells(spark, [(k, "1") for k in keys]).coalesce(1).write.mode("append").parquet(f"{base}/s")
    with pytest.raises(ValueError):
        S.check_staging(spark, f"{base}/s")


def test_staging_of_one_key_over_files_and_empty_files(spark):
    base = scratch_path(spark, "t-edges")
    for keys in (["a", "b"], [], ["c"]):
        _cells(spark, [(k, "1") for k in keys]).coalesce(1).write.mode("append").parquet(f"{base}/s")
    S.check_staging(spark, f"{base}/s")
    spark.createDataFrame([], "rowkey string, family string, qualifier string, value string").write.parquet(f"{base}/e")
    S.check_staging(spark, f"{base}/e")


def test_copied_layer_keeps_the_order(spark):
    base = scratch_path(spark, "t-copy")
    staging = S.write_sorted_cells(_contact_cells(spark), f"{base}/s", files=16)
    S.check_staging(spark, S.publish(spark, staging, f"{base}/t"))


def test_sort_of_long_values_keeps_them_out_of_the_sample(spark):
    wide = spark.range(400).select(
        F.format_string("k%03d", F.col("id") % 7).alias("rowkey"), F.lit("cf").alias("family"), F.lit("q").alias("qualifier"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 200).alias("value"))
    keys = [a.toString() for a in _range_keys(CE.sort_cells(wide, 20))]
    assert len(keys) == 5 and not any(k.startswith("value") for k in keys)
    assert CE.sort_cells(wide, 20).count() == 400


def _range_keys(df):
    """Columns of the range exchange."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while "RepartitionByExpression" not in plan.nodeName():
        plan = plan.children().apply(0)
    found = plan.partitionExpressions()
    return [found.apply(i) for i in range(found.size())]


def test_upsert_partial_batch_keeps_untouched(spark):
    target = scratch_path(spark, "t-upsert-partial")
    schema = "k string, r long, v string"
    S.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("b", 3, "y3")], schema), target, "k", "r")
    S.upsert(spark.createDataFrame([("c", 1, "z"), ("a", 0, "stale")], schema), target, "k", "r")
    got = sorted(tuple(r) for r in S.read_rows(spark, target, "k", "r").collect())
    S.merge_rows(spark, target, f"{target}-merged", "k", "r")
    assert len(S.batches(spark, f"{target}-merged")) == 1
    assert sorted(tuple(r) for r in S.read_rows(spark, f"{target}-merged", "k", "r").collect()) == got
    assert got == [("a", 1, "x"), ("b", 3, "y3"), ("c", 1, "z")]


def test_merged_target_goes_on(spark):
    base = scratch_path(spark, "t-merged")
    schema = "rowkey string, family string, qualifier string, value string"
    target, into = f"{base}/table", f"{base}/merged"
    assert S.merge_cells(spark, target, into) is None and S.merge_rows(spark, target, into, "rowkey", "value") is None
    for i, rows in enumerate([[("k1", "cf", "q", "a"), ("k2", "cf", "q", "b")], [("k1", "cf", "q", "c")]]):
        S.publish(spark, S.write_sorted_cells(spark.createDataFrame(rows, schema), f"{base}/s{i}"), target)
    S.merge_cells(spark, target, into)
    merged = S.read_cells(spark, into)
    assert "Aggregate" not in merged._jdf.queryExecution().executedPlan().toString()  # one batch is read as it is
    assert sorted(tuple(r) for r in merged.collect()) == [("k1", "cf", "q", "c"), ("k2", "cf", "q", "b")]
    S.publish(spark, S.write_sorted_cells(spark.createDataFrame([("k2", "cf", "q", "d")], schema), f"{base}/s9"), into)
    assert sorted(tuple(r) for r in S.read_cells(spark, into).collect()) == [("k1", "cf", "q", "c"), ("k2", "cf", "q", "d")]


def test_staged_files_on_given_points(spark):
    """Each file lies within one region; a region without cells has no file."""
    base = scratch_path(spark, "t-points")
    cells = _contact_cells(spark)
    keys = sorted({r.rowkey for r in cells.select("rowkey").collect()})
    points = [keys[len(keys) // 3], keys[len(keys) // 3] + "~", keys[-1]]
    staging = S.write_sorted_cells(cells, f"{base}/s", points=points)
    S.check_staging(spark, staging)
    seen = {}
    for f in glob.glob(os.path.join(staging.replace("file:", ""), "*.parquet")):
        held = pq.read_table(f).to_pydict()["rowkey"]
        if held:
            seen[int(os.path.basename(f).split("-")[1])] = (min(held), max(held), len(held))
    edges = ["", *sorted(points), "\U0010ffff"]
    assert all(edges[i] <= lo and hi < edges[i + 1] for i, (lo, hi, _) in seen.items())
    assert sum(n for *_, n in seen.values()) == cells.count() and len(seen) >= 3


def test_stream_batch_is_written_once(spark):
    base = scratch_path(spark, "t-stream-upsert")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, r long, v string")
    df.write.parquet(f"{base}/src")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/src")
    S.stream_upsert(stream, f"{base}/t", "k", "r", f"{base}/c1", "s").awaitTermination()
    assert S.batches(spark, f"{base}/t") == [S.stream_batch("s", 0)]
    # The checkpoint is lost and the first batch comes again with other rows: the one that is there stays.
    spark.createDataFrame([("a", 9, "z")], df.schema).write.mode("append").parquet(f"{base}/src")
    S.stream_upsert(stream, f"{base}/t", "k", "r", f"{base}/c2", "s").awaitTermination()
    assert sorted(r.v for r in S.read_rows(spark, f"{base}/t", "k", "r").collect()) == ["x", "y"]


def test_nested_values_become_json_text(spark):
    df = spark.createDataFrame([("k", {"a": 1}, [1, 2])], "rowkey string, m map<string,int>, l array<int>")
    got = {r["qualifier"]: r["value"] for r in CE.to_cells(df, "rowkey").collect()}
    assert got == {"l": "[1,2]", "m": '{"a":1}'}


def test_published_documents_are_whole_rows(spark):
    from cellsmith.plans import jobs

    base = scratch_path(spark, "t-whole")
    t = "2018-04-24 22:13:20.000"
    docs = spark.createDataFrame([("A", t, "13800000001", "z"), ("B", t, "13800000001", "a")],
                                 "_id string, create_time string, mobile string, moxie_carrier_originalInfo string")
    docs = docs.selectExpr("*", "cast(null as string) successFlag", "cast(null as string) task_id", "'' update_time")
    S.publish(spark, S.write_sorted_cells(jobs.raw_docs_latest(docs), f"{base}/s", presorted=True), f"{base}/t")
    got = {r["qualifier"]: r["value"] for r in S.read_cells(spark, f"{base}/t").collect()}
    assert (got["_id"], got["moxie_carrier_originalInfo"]) == ("B", "a")


def test_hot_repeated_row_key_spreads_over_partitions(spark):
    # a third of the rows share one row key (keys are not unique)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%05d", "id")).alias("rowkey"),
        F.col("id").cast("string").alias("a"))
    cells = CE.sorted_cells(df, "rowkey", ["a"], partitions=6)
    sizes = cells.rdd.mapPartitions(lambda it: [sum(1 for r in it if r[0] == "hot")]).collect()
    assert sum(sizes) == 1000 and max(sizes) < 1000
    flat = [(r[0].encode(), r[2].encode(), r[3].encode()) for r in cells.collect()]
    assert flat == sorted(flat)


def test_publish_by_move(spark):
    base = scratch_path(spark, "t-move")
    cells = _contact_cells(spark)
    staging = S.write_sorted_cells(cells, f"{base}/stage", presorted=True)
    path = S.publish(spark, staging, f"{base}/table", move=True)
    assert path == S.batch_path(f"{base}/table", S.batches(spark, f"{base}/table")[0])
    assert not os.path.exists(staging.replace("file:", ""))
    assert sorted(tuple(r) for r in S.read_cells(spark, f"{base}/table").collect()) == sorted(
        tuple(r) for r in cells.collect())


def test_partitions_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """Batches and what is read back come in ranges of a bounded number of rows."""
    from cellsmith.operators import ranges as R

    monkeypatch.setattr(R, "ROWS", 100)
    cells = spark.range(3000).selectExpr("lpad(cast(id as string), 6, '0') AS rowkey", "'cf' AS family", "'q' AS qualifier", "cast(id as string) AS value")
    staging = S.write_sorted_cells(cells, f"{tmp_path}/staging")
    for _ in range(2):
        assert len(spark.read.parquet(S.publish(spark, staging, f"{tmp_path}/t")).inputFiles()) == 30
    got = S.read_cells(spark, f"{tmp_path}/t")
    assert got.rdd.getNumPartitions() == 60 and got.count() == 3000
