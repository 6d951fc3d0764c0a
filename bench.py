"""Bench: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Inputs are derived from the driver tables and stored once (not timed), as
the jobs read them in production; each job is then run to a ``noop`` sink
five times and the median wall time is reported.  Comparison entry:
written the way the reference writes it (full row lists per key, then
``sortByKey``).

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellsmith.plans import jobs  # noqa: E402
from cellsmith.session import local_session, scratch_path  # noqa: E402
from cellsmith.sources import fixtures as fx  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def rdd_groups_w1(spark, docs_path: str):
    """Reference-style W1 for comparison: RDD flatMap, groupBy lists, sortByKey."""
    from pyspark.sql import functions as F

    from cellsmith.functions import columns as C
    from cellsmith.operators.nested import flatten_calls, parse_calls

    docs = spark.read.parquet(docs_path)
    flat = flatten_calls(parse_calls(docs).where("_valid"), "doc", keep=("_id", "mobile"))
    rows = flat.select(
        C.call_key("mobile", "time", "dial_type").alias("base"), F.col("_id").alias("id"),
        "call_pos", "item_pos", "dial_type", "duration", C.fee_text("fee").alias("fee"),
        "location", "location_type", "mobile", C.normalize_phone("peer_number").alias("peer_number"), "time",
    ).where("base is not null")
    fields = jobs.CALL_FIELDS

    def number(group):
        base, items = group
        items = sorted(items, key=lambda r: (r["id"], r["call_pos"], r["item_pos"]))
        seen, out = set(), []
        for r in items:
            k = (r["peer_number"], r["time"])
            if k not in seen:
                seen.add(k)
                out.append(r)
        return [(base + str(i), [(f, "" if r[f] is None else str(r[f])) for f in fields])
                for i, r in enumerate(out)]

    cells = (rows.rdd.groupBy(lambda r: r["base"]).flatMap(number).sortByKey()
             .flatMap(lambda kv: [(kv[0], "cf", q, v) for q, v in kv[1]]))
    return cells.count()


def main() -> None:
    spark = local_session(CPUS, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", CPUS)))
    store = scratch_path(spark, "bench")  # the session's shared folder
    paths = {
        "call_docs": f"{store}/call_docs", "raw_docs": f"{store}/raw_docs", "contacts": f"{store}/contacts",
    }
    fx.call_docs(spark, SF_DIR).write.parquet(paths["call_docs"])
    fx.raw_docs(spark, SF_DIR).write.parquet(paths["raw_docs"])
    fx.contacts(spark, SF_DIR).write.parquet(paths["contacts"])

    def w1():
        cells, _ = jobs.calls_to_cells(spark.read.parquet(paths["call_docs"]))
        noop(cells)

    def w2():
        noop(jobs.raw_docs_to_cells(spark.read.parquet(paths["raw_docs"])))

    def w3():
        noop(jobs.contacts_to_cells(spark.read.parquet(paths["contacts"])))

    headline = {"calls_to_cells": w1, "raw_docs_to_cells": w2, "contacts_to_cells": w3}
    results: dict[str, float] = {}
    for name, fn in headline.items():
        fn()  # warm-up (JIT, file listing)
        results[name] = round(statistics.median(timed(fn) for _ in range(RUNS)), 3)
    extra = {}
    if os.environ.get("BENCH_SKIP_RDD") != "1":
        extra["w1_rdd_groups"] = round(timed(lambda: rdd_groups_w1(spark, paths["call_docs"])), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_jobs_total_wall",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "comparison": extra,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
