"""Sinks (K1-K7): staged sorted cell files, publish in batches, keyed upsert.

A target is a folder of batches, which Spark reads as a partition column::

    <target>/_batch=<id>/    parquet, sorted, non-overlapping files

A batch is written by Spark outside the target and moved in by one folder rename, so
readers see all of it or nothing.  A batch id is used once: publishing
it again changes nothing, which makes a repeated stream batch or a retried job
harmless.  Writers of different batches do not meet.

Publishing costs the batch, not the table, like a bulk load adds files.
Readers resolve repeated keys with an aggregate: the value of the latest
batch (``read_cells``), or the newest row by a recency column (``read_rows``).  Batches are
in the order of their ids; the default id begins with the time.  ``merge_cells`` and
``merge_rows`` write that state as one batch of a new target.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellsmith.operators.cells import sort_cells
from cellsmith.operators.keys import latest_per_key
from cellsmith.operators.ranges import partitions_for, place, range_of

CELL_KEY = ["rowkey", "family", "qualifier"]
BATCH = "_batch"


# ---------------------------------------------------------------------------
# Hadoop FileSystem helpers (work for local, HDFS and object stores)
# ---------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


# ---------------------------------------------------------------------------
# Staging (K2, K5, K6, K7)
# ---------------------------------------------------------------------------

def staging_path(base: str, table: str, millis: int | None = None) -> str:
    """``<base>/bulkload/<ns>/<table>_<millis>`` (K6); ``ns:table`` becomes ``ns/table``."""
    millis = millis if millis is not None else int(time.time() * 1000)
    return f"{base.rstrip('/')}/bulkload/{table.replace(':', '/')}_{millis}"


def write_sorted_cells(
    cells: DataFrame, staging: str, files: int | None = None, compression: str = "snappy",
    presorted: bool = False, points: Sequence[str] | None = None,
) -> str:
    """Write cells as sorted, non-overlapping parquet files (K2, K7).

    ``files`` caps the number of files (range partitions); ``presorted``
    skips the sort for cells that come out of ``sorted_cells``.  ``points`` are
    the rising row keys at which a target is split into regions: file ``i`` then holds the
    cells of region ``i`` alone, keys from ``points[i - 1]`` up to, but without, ``points[i]``.
    """
    if points is not None:
        rows = [{"rowkey": p} for p in sorted(points, key=lambda x: x.encode("utf-8"))]
        spread = place(cells, range_of(cells, ["rowkey"], rows), len(rows) + 1)
        out = spread.drop("_range").sortWithinPartitions(*CELL_KEY)
    else:
        out = cells if presorted and files is None else sort_cells(cells, files)
    out.write.mode("errorifexists").option("compression", compression).parquet(staging)
    return staging


def _less(a: pa.RecordBatch, b: pa.RecordBatch) -> np.ndarray:
    """Row by row: is the cell key of ``a`` below that of ``b`` in byte order (a null: no)."""
    out = pc.less(a.column(2), b.column(2))
    for k in (1, 0):
        out = pc.or_(pc.less(a.column(k), b.column(k)), pc.and_(pc.equal(a.column(k), b.column(k)), out))
    return out.fill_null(False).to_numpy(zero_copy_only=False)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file split: its first and last cell key, and whether its keys rise strictly."""
    names = ["file", "start", "lo", "hi", "rising"]
    key = pa.struct([(c, pa.string()) for c in CELL_KEY])
    types = [pa.string(), pa.int64(), key, key, pa.bool_()]

    def out(run: dict) -> pa.RecordBatch:
        lo, hi = ({c: x.column(i)[0].as_py() for i, c in enumerate(CELL_KEY)} for x in (run["first"], run["last"]))
        row = [*run["at"], lo, hi, run["rising"]]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    run: dict | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        up = _less(batch.slice(0, n - 1), batch.slice(1))
        file, start = batch.column(3), batch.column(4)
        turn = pc.or_(pc.not_equal(file.slice(0, n - 1), file.slice(1)), pc.not_equal(start.slice(0, n - 1), start.slice(1)))
        edges = [0, *(np.flatnonzero(turn.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        for i, j in zip(edges, edges[1:]):
            at, first, last = (file[i].as_py(), start[i].as_py()), batch.slice(i, 1), batch.slice(j - 1, 1)
            rising = bool(up[i: j - 1].all())
            if run and run["at"] == at:
                run["rising"] = run["rising"] and rising and bool(_less(run["last"], first)[0])
                run["last"] = last
            else:
                if run:
                    yield out(run)
                run = {"at": at, "first": first, "last": last, "rising": rising}
    if run:
        yield out(run)


def file_spans(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, lo, hi, rising`` per file split of a folder of cells.  Reads the key columns; no shuffle."""
    keys = spark.read.parquet(path).select(
        *CELL_KEY, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    key = ", ".join(f"{c}: string" for c in CELL_KEY)
    return keys.mapInArrow(_spans, f"file string, start long, lo struct<{key}>, hi struct<{key}>, rising boolean")


def check_staging(spark: SparkSession, staging: str) -> None:
    """Validate staged cells: keys ``(rowkey, family, qualifier)`` rise
    strictly inside every file, and the files' spans do not overlap (one row
    key may end one file and start the next).  With both, no key repeats.
    Raises ``ValueError`` otherwise.

    Neighbours are compared inside each file split; only the edges of the
    splits (one row per split) are sorted and compared.
    """
    before = Window.orderBy("lo", "file", "start")
    edges = file_spans(spark, staging).select(
        "file", "rising",
        (F.lag("hi").over(before) >= F.col("lo")).alias("overlap"),
        (F.lag("file").over(before) == F.col("file")).alias("same"),
        (F.lag("start").over(before) > F.col("start")).alias("back"))
    seen = edges.agg(
        F.count_if(~F.col("rising")).alias("unsorted"), F.count_if("overlap").alias("overlaps"),
        F.count_if(F.col("same") & F.col("back")).alias("backward"),
        F.count_if(~F.coalesce(F.col("same"), F.lit(False))).alias("runs"), F.count_distinct("file").alias("files")).first()
    if seen["unsorted"] or seen["backward"]:
        raise ValueError(f"staged cells in {staging} are not sorted by, or repeat, a (rowkey, family, qualifier)")
    if seen["overlaps"] or seen["runs"] != seen["files"]:
        raise ValueError(f"staged files in {staging} overlap in cell order or repeat a (rowkey, family, qualifier)")


# ---------------------------------------------------------------------------
# Batches (K3, K4, K1)
# ---------------------------------------------------------------------------

def new_batch() -> str:
    """A batch id of its own that sorts behind earlier ones."""
    return f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"


def batches(spark: SparkSession, target: str) -> list[str]:
    """Ids of the published batches, in order."""
    return sorted(n.split("=b-", 1)[1] for n in _list_names(spark, target) if n.startswith(f"{BATCH}=b-"))


def batch_path(target: str, batch: str) -> str:
    # The letter keeps Spark from reading ids of digits as numbers.
    return f"{target.rstrip('/')}/{BATCH}=b-{batch}"


def _move_in(spark: SparkSession, written: str, target: str, batch: str) -> str:
    """Rename a written folder into the target (one step on HDFS; object stores copy)."""
    path = batch_path(target, batch)
    fs, src = _fs(spark, written)
    _, dst = _fs(spark, path)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {written} to {path}")
    return path


def _write_batch(data: DataFrame, target: str, batch: str, compression: str) -> str:
    spark = data.sparkSession
    aside = f"{target.rstrip('/')}_writing/{uuid.uuid4().hex}"
    data.write.mode("errorifexists").option("compression", compression).parquet(aside)
    return _move_in(spark, aside, target, batch)


def publish(spark: SparkSession, staging: str, target: str, validate: bool = True,
            compression: str = "snappy", move: bool = False, batch: str | None = None) -> str:
    """Publish staged cells into ``target`` as one batch (K3, K4); returns the batch's folder.

    A staged cell wins over those of earlier batches on equal ``(rowkey, family, qualifier)``
    when read.  A ``batch`` that is there already is left as it is.  The staging must hold sorted
    unique cells (``check_staging``); jobs whose keys repeat resolve whole rows
    before the reshape, so that a published row is always one input row.

    ``move=True`` renames the staging folder into the table, as a bulk load
    moves its files; the staging folder is gone afterwards.  Otherwise the
    staging stays, and its cells are range-sorted again into the batch, as
    reading them back packs several files into a task.
    """
    batch = batch or new_batch()
    if batch in batches(spark, target):
        return batch_path(target, batch)
    if validate:
        check_staging(spark, staging)
    if move:
        return _move_in(spark, staging, target, batch)
    cells = spark.read.parquet(staging)
    return _write_batch(sort_cells(cells, partitions_for(cells, cells.count())), target, batch, compression)


def publish_existing(spark: SparkSession, staging: str, target: str, validate: bool = True,
                     move: bool = False, batch: str | None = None) -> str:
    """Publish a staging folder written by an earlier job."""
    if not _exists(spark, staging):
        raise FileNotFoundError(staging)
    return publish(spark, staging, target, validate, move=move, batch=batch)


def upsert(df: DataFrame, target: str, key: str | list[str], recency: str | list[str],
           compression: str = "snappy", batch: str | None = None) -> str:
    """Keyed write of wide rows (K1): ``df`` becomes a batch; per key the
    newest row by ``recency`` over all batches is what ``read_rows`` shows.
    Cost: the batch (sorted by key), not the table.  A ``batch`` that is there already is left as it is."""
    spark = df.sparkSession
    batch = batch or new_batch()
    if batch in batches(spark, target):
        return batch_path(target, batch)
    keys = [key] if isinstance(key, str) else list(key)
    order = keys + ([recency] if isinstance(recency, str) else list(recency))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # (key, recency): a key repeated on many rows of the batch is split over partitions
    return _write_batch(df.repartitionByRange(n, *order).sortWithinPartitions(*order), target, batch, compression)


def stream_upsert(stream: DataFrame, target: str, key: str | list[str], recency: str | list[str],
                  checkpoint: str, name: str = "stream") -> StreamingQuery:
    """K1 as a stream sink: every micro-batch is an upsert under an id made of ``name`` and the batch's number.

    Spark may run a micro-batch again after a failure; its id is there then, so nothing changes.
    Processes what is available now and stops."""
    def write(rows: DataFrame, number: int) -> None:
        upsert(rows, target, key, recency, batch=stream_batch(name, number))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_batch(name: str, number: int) -> str:
    return f"{name}-{number:012d}"


def read_cells(spark: SparkSession, target: str) -> DataFrame | None:
    """Visible cells: per ``(rowkey, family, qualifier)`` the value of the
    latest batch.  A single batch is read as it is.  ``None`` before the first publish."""
    there = batches(spark, target)
    if not there:
        return None
    cells = spark.read.parquet(target)
    if len(there) > 1:  # a key is on one row a batch
        cells = latest_per_key(cells, CELL_KEY, BATCH, partitions_for(cells, cells.count()))
    return cells.drop(BATCH)


def read_rows(spark: SparkSession, target: str, key: str | list[str], recency: str | list[str]) -> DataFrame | None:
    """Visible wide rows: per key the newest row by ``recency`` (the latest
    batch breaks ties).  ``None`` before the first write."""
    if not batches(spark, target):
        return None
    keys = [key] if isinstance(key, str) else list(key)
    recency = [recency] if isinstance(recency, str) else list(recency)
    return latest_per_key(spark.read.parquet(target), keys, [*recency, BATCH]).drop(BATCH)


def merge_cells(spark: SparkSession, target: str, into: str, compression: str = "snappy") -> str | None:
    """Write the visible cells of ``target`` as the first batch of the new target ``into``."""
    state = read_cells(spark, target)
    return state and _write_batch(sort_cells(state), into, new_batch(), compression)


def merge_rows(spark: SparkSession, target: str, into: str, key: str | list[str], recency: str | list[str],
               compression: str = "snappy") -> str | None:
    """Write the visible rows of ``target`` as the first batch of the new target ``into``."""
    state = read_rows(spark, target, key, recency)
    return state and upsert(state, into, key, recency, compression)
