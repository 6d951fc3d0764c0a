"""Command-line jobs, one per original batch program.

    python -m cellsmith.plans.cli calls    <input> <target> [--staging DIR] [--table] [--files N]
    python -m cellsmith.plans.cli raw      <input> <target> [--staging DIR] [--table]
    python -m cellsmith.plans.cli contacts <input> <target> [--staging DIR] [--table] [--order-by COL ...] [--plain]
    python -m cellsmith.plans.cli wide     <input> <target> --recency COL [--table]
    python -m cellsmith.plans.cli publish  <staging> <target>

``<input>`` is a parquet path (or a catalog table with ``--table``).  Cell
jobs write sorted cells to ``<staging>/bulkload/<target name>_<millis>`` and
publish them into ``<target>`` as one layer by moving that folder.  Documents
(``raw``) and contacts (``--plain``) that share a key are resolved as whole
rows.  Rows that cannot be keyed are written to ``..._rejects`` beside the
staging folder.  The staging base defaults to the session's shared
folder.  Session settings (partitions, checkpoint dir) come from
``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from cellsmith.plans import jobs
from cellsmith.session import shared_dir
from cellsmith.sinks import files as S


def _read(spark: SparkSession, source: str, table: bool):
    return spark.table(source) if table else spark.read.parquet(source)


def _stage_and_publish(spark, cells, target: str, staging_base: str | None, files: int | None = None) -> str:
    name = target.rstrip("/").split("/")[-1]
    staging = S.staging_path(staging_base or shared_dir(spark), name)
    S.write_sorted_cells(cells, staging, files=files, presorted=True)
    # The job's own staging folder is moved into the table, as a bulk load
    # moves its files.
    S.publish(spark, staging, target, move=True)
    return staging


def _write_rejects(rejects, staging: str) -> str:
    rejects.write.mode("errorifexists").parquet(staging + "_rejects")
    return staging + "_rejects"


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="cellsmith")
    p.add_argument("job", choices=["calls", "raw", "contacts", "wide", "publish"])
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--staging", default=None)
    p.add_argument("--table", action="store_true", help="read a catalog table instead of a parquet path")
    p.add_argument("--order-by", nargs="+", default=["ord"], help="tie-break columns for contact ordinals")
    p.add_argument("--exclude", nargs="*", default=None, help="contact columns left out of the cells")
    p.add_argument("--plain", action="store_true", help="contacts keyed as they are (no ordinals)")
    p.add_argument("--recency", nargs="+", default=None, help="recency columns of the wide upsert")
    p.add_argument("--strict", action="store_true", help="fail on rows the keys cannot be built for")
    p.add_argument("--files", type=int, default=None, help="number of staged files (range partitions)")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"cellsmith-{a.job}").getOrCreate()

    if a.job == "publish":
        return {"published": S.publish_existing(spark, a.source, a.target)}
    df = _read(spark, a.source, a.table)
    if a.job == "calls":
        cells, rejects = jobs.calls_to_cells(df, strict=a.strict, once=True)
        staging = _stage_and_publish(spark, cells, a.target, a.staging, a.files)
        return {"staging": staging, "rejects": _write_rejects(rejects, staging)}
    if a.job == "raw":
        return {"staging": _stage_and_publish(spark, jobs.raw_docs_latest(df), a.target, a.staging, a.files)}
    rejects = jobs.contact_rejects(df)
    if a.job == "contacts":
        exclude = a.exclude if a.exclude is not None else [c for c in a.order_by if c in df.columns]
        cells = (jobs.contacts_to_cells_latest(df, a.order_by, exclude) if a.plain
                 else jobs.contacts_to_cells(df, a.order_by, exclude, strict=a.strict))
        staging = _stage_and_publish(spark, cells, a.target, a.staging, a.files)
        return {"staging": staging, "rejects": _write_rejects(rejects, staging)}
    if not a.recency:
        p.error("wide needs --recency")
    rows = jobs.contact_rows(df, exclude=(), raw=tuple(a.recency))
    name = a.target.rstrip("/").split("/")[-1]
    written = S.upsert(rows, a.target, "rowkey", a.recency)
    return {"written": written,
            "rejects": _write_rejects(rejects, S.staging_path(a.staging or shared_dir(spark), name))}


def main() -> None:
    print(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
