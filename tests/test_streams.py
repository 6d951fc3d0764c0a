"""Streams on a file source: batch equals stream, pacing, restart adds nothing."""

from pyspark.sql import functions as F

from cellsmith.session import scratch_path
from cellsmith.sources import fixtures as fx
from cellsmith.streaming import messages as M

SF = "/root/testdata/sf0.001"


def _src(spark, name, files=3):
    base = scratch_path(spark, name)
    msgs = fx.messages(spark, SF)
    msgs.repartition(files).write.parquet(f"{base}/src")
    return base, msgs


def test_stream_equals_batch_and_paced(spark):
    base, msgs = _src(spark, "t-stream", 3)
    stream = M.read_messages(spark, "parquet", f"{base}/src", per_trigger=1).select("key", "value", "topic", "offset")
    batches = M.run_available(stream, f"{base}/sink", f"{base}/ckpt")
    assert batches == 3
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/sink").collect())
    assert got == sorted(tuple(r) for r in msgs.select("key", "value", "topic", "offset").collect())


def test_restart_adds_nothing(spark):
    base, msgs = _src(spark, "t-restart", 2)
    stream = M.read_messages(spark, "parquet", f"{base}/src").select("key", "offset")
    M.run_available(stream, f"{base}/sink", f"{base}/ckpt")
    n = spark.read.parquet(f"{base}/sink").count()
    assert M.run_available(stream, f"{base}/sink", f"{base}/ckpt") == 0
    assert spark.read.parquet(f"{base}/sink").count() == n == msgs.count()


def test_latest_skips_backlog(spark):
    base, msgs = _src(spark, "t-latest", 2)
    stream = M.read_messages(spark, "parquet", f"{base}/src").select("key", "offset")
    M.prime_latest(stream, f"{base}/sink", f"{base}/ckpt")
    msgs.limit(5).withColumn("offset", F.col("offset") + 10**9).write.mode("append").parquet(f"{base}/src")
    M.run_available(stream, f"{base}/sink", f"{base}/ckpt")
    got = [r["offset"] for r in spark.read.parquet(f"{base}/sink").collect()]
    assert len(got) == 5 and all(o >= 10**9 for o in got)


def test_topics_and_format(spark):
    base, msgs = _src(spark, "t-topics", 2)
    stream = M.format_lines(M.read_messages(spark, "parquet", f"{base}/src", topics=["click"]))
    M.run_available(stream, f"{base}/sink", f"{base}/ckpt")
    lines = [r["line"] for r in spark.read.parquet(f"{base}/sink").collect()]
    assert len(lines) == msgs.where("topic = 'click'").count()
    assert all(line.startswith("offset = ") and ", key = " in line for line in lines)


def test_decode_roundtrip(spark):
    base = scratch_path(spark, "t-json")
    e = fx.read_table(spark, SF, "events").select("event_id", "user_id", "event_type")
    sent = M.encode_messages(e, ["user_id", "event_type"], key_col="event_id")
    M.write_messages(sent, "parquet", f"{base}/topic")
    back = M.decode_messages(spark.read.parquet(f"{base}/topic"), "user_id bigint, event_type string")
    assert sorted(tuple(r) for r in back.collect()) == sorted(
        (str(r[0]), r[1], r[2]) for r in e.collect())


def test_processing_time_trigger_runs_until_stopped(spark):
    base, msgs = _src(spark, "t-continuous", 3)
    stream = M.read_messages(spark, "parquet", f"{base}/src", per_trigger=1).select("key", "offset")
    q = M.start_stream(stream, f"{base}/sink", f"{base}/ckpt", processing_time="200 milliseconds")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(f"{base}/sink").count() == msgs.count()


def test_console_sink(spark):
    base, _ = _src(spark, "t-console", 1)
    lines = M.format_lines(M.read_messages(spark, "parquet", f"{base}/src")).limit(3)
    q = M.start_stream(lines.select("line"), None, f"{base}/ckpt", fmt="console",
                       options={"truncate": "false", "numRows": "3"}, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert q.exception() is None
        assert sum(p.get("numInputRows", 0) for p in q.recentProgress) > 0
    finally:
        q.stop()
