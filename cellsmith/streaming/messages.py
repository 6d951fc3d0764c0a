"""Message streams (S6-S10, F6, K8-K10, J4, W7, W8) on Structured Streaming.

The broker source is ``format="kafka"`` with ``subscribe`` and
``startingOffsets``; any file format works the same way with a message
schema.  Offsets are tracked by the query checkpoint (S10), which resumes
exactly after the last finished micro-batch.  Pacing is
``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` (S9).

No Kafka jar ships with PySpark, so the tests drive these functions with
parquet files; the broker path is the same code with other options.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellsmith.functions import columns as C

MESSAGE_SCHEMA = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    topics: Sequence[str] | None = None,
    starting: str = "earliest",
    per_trigger: int | None = None,
    max_bytes: int | None = None,
    options: dict | None = None,
    schema: str = MESSAGE_SCHEMA,
) -> DataFrame:
    """A message stream ``(key, value, topic, partition, offset, timestamp)``.

    ``per_trigger`` paces by messages (broker) or files, ``max_bytes`` by the size of files, whatever
    their number; a batch takes one file more than fits only if it is its first.
    ``topics`` restricts the stream (F6).  ``starting`` is ``earliest`` (S6,
    S7) or ``latest`` (S8).  For file sources ``latest`` is obtained with
    ``prime_latest`` on the query's checkpoint, since files carry no offsets.
    """
    options = dict(options or {})
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**options)
        if topics:
            reader = reader.option("subscribe", ",".join(topics))
        reader = reader.option("startingOffsets", starting)
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(per_trigger))
        df = reader.load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp")
    else:
        reader = spark.readStream.format(fmt).schema(schema).options(**options)
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(per_trigger))
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", str(max_bytes))
        df = reader.load(path)
        if topics:
            df = df.where(F.col("topic").isin(list(topics)))
    return df


def format_lines(df: DataFrame) -> DataFrame:
    """``offset = %d, key = %s, value = %s`` per message."""
    return df.select(C.format_message(F.col("offset"), F.col("key"), F.col("value")).alias("line"))


def decode_messages(df: DataFrame, schema: str, keep: Sequence[str] = ("key",)) -> DataFrame:
    """JSON value -> typed fields."""
    parsed = F.from_json(F.col("value"), schema)
    st = T._parse_datatype_string(schema)
    return df.select(*keep, *[parsed[f.name].alias(f.name) for f in st.fields])


def encode_messages(df: DataFrame, value_cols: Sequence[str], key_col: str | None = None) -> DataFrame:
    """Rows -> ``(key, value)`` messages: JSON value (J3) and a time key."""
    key = F.col(key_col).cast("string") if key_col else C.message_key()
    return df.select(key.alias("key"), F.to_json(F.struct(*value_cols)).alias("value"))


def start_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
    options: dict | None = None, processing_time: str | None = None,
) -> StreamingQuery:
    """Write a stream to ``path`` (exactly once through the sink log and the
    checkpoint).  Without ``processing_time`` the query processes what is
    available now and stops; with it, it runs on that trigger until stopped."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).options(**(options or {}))
    if fmt not in ("kafka", "console", "memory"):
        w = w.option("path", path)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def run_available(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  options: dict | None = None) -> int:
    """Process everything available now; returns the number of micro-batches."""
    q = start_stream(df, path, checkpoint, fmt, options)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return len([p for p in q.recentProgress if p.get("numInputRows", 0) > 0])


def prime_latest(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Mark everything present now as consumed on ``checkpoint`` so that the
    next run of the same query sees only later data (``latest`` for file
    sources).  The filter change between runs is allowed by the checkpoint."""
    run_available(df.where(F.lit(False)), path, checkpoint, fmt)


def write_messages(df: DataFrame, fmt: str = "kafka", path: str | None = None,
                   options: dict | None = None) -> None:
    """Batch message sink (K8): ``value`` (and ``key`` when present) text."""
    cols = [c for c in ("key", "value", "topic") if c in df.columns]
    w = df.select(*cols).write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode("errorifexists").save(path)
