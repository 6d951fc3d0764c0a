"""Plan shape: pushed filters, pruned scans, no Python UDF, exchange count."""

import pytest

from cellsmith.plans import jobs
from cellsmith.session import scratch_path
from cellsmith.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_docs(spark):
    path = scratch_path(spark, "t-docs")
    fx.call_docs(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_call_job_plan(spark, stored_docs):
    cells, _ = jobs.calls_to_cells(stored_docs, once=False)
    plan = plan_text(cells)
    assert "IsNotNull(moxie_carrier_originalInfo)" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # one exchange serves keep-first, the ordinal and the final order
    assert plan.count("Exchange") == 1 and "shufflepartitionidpassthrough" in plan


def test_contact_job_plan(spark):
    plan = plan_text(jobs.contacts_to_cells(fx.contacts(spark, SF)))
    assert plan.count("Exchange") == 1 and "shufflepartitionidpassthrough" in plan


def test_numbering_plan(spark):
    """One exchange of the rows; what is carried comes as a small table of the cut keys."""
    from cellsmith.operators import ranges as R

    df = spark.range(1000).selectExpr("concat('k', id % 7) AS base", "id")
    points = [{"base": "k3", "id": 400}, {"base": "k5", "id": 1}]
    got = R.number_ranges(df, "base", ["id"], points=points)
    assert plan_text(got).count("shufflepartitionidpassthrough") == 1
    assert {(r.base, r.id, r.seq) for r in got.collect()} == {(f"k{i % 7}", i, i // 7) for i in range(1000)}


def test_bucketed_table_is_grouped_without_an_exchange(spark):
    from cellsmith.plans import catalog

    got = catalog.queries()["scan_bucketed"](spark, SF)
    plan = plan_text(got)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert got.count() > 0


def test_scan_is_pruned(spark):
    plan = plan_text(jobs.raw_docs_to_cells(fx.raw_docs(spark, SF)))
    # events.value (a double) is never read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    contacts = plan_text(jobs.contacts_to_cells(fx.contacts(spark, SF)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in contacts


def test_library_stays_on_the_jvm_path():
    """No Python UDFs, RDDs (the staging check compares Arrow batches), driver collects of data, local checkpoints or
    machine-local temp folders in library code (session.py's test-only
    fallback for an unset checkpoint dir excepted)."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[1] / "cellsmith"
    banned = re.compile(r"localCheckpoint|pandas_udf|\budf\(|toPandas|\.rdd\b|mapInPandas|applyInPandas")
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:  # free to choose its style
            continue
        text = path.read_text()
        assert not banned.search(text), path
        if path.name != "session.py":
            assert "tempfile" not in text, path


def test_latest_per_key_combines_map_side(spark):
    from cellsmith.plans import jobs as J
    plan = plan_text(J.contacts_latest(fx.contacts(spark, SF)))
    assert "partial_max" in plan


def test_documents_are_made_and_parsed_once(spark):
    from cellsmith.plans import catalog

    q = catalog.queries()
    for name, parse in (("peer_tail", "from_json("), ("fee_text", "from_json("), ("call_key", "from_json("),
                        ("open_calls", "parseJson("), ("open_cells", "parseJson(")):
        plan = plan_text(q[name](spark, SF))
        assert plan.count(parse) == 1, name
        assert plan.count("StructsToJsonEvaluator") <= 1, name
    assert plan_text(fx.call_docs(spark, SF)).count("Exchange") == 1


def test_keep_first_moves_the_columns_it_returns(spark):
    from cellsmith.plans import catalog

    plan = plan_text(catalog.queries()["dedup_keep_first"](spark, SF))
    assert "location_type" not in plan[plan.index("partial_min(struct("):].split("\n")[0]


def test_numbering_reads_the_kept_items_from_files(spark):
    from cellsmith.plans import catalog

    assert "from_json(" not in plan_text(catalog.queries()["call_sequence"](spark, SF))


def test_documents_of_odd_lines(spark, tmp_path):
    """Null keys and repeated keys: lines in the order of their items' texts."""
    import json
    from datetime import datetime

    day = datetime(1996, 3, 13)
    lines = [(7, 5, 3, 1, 9.0, "N", day), (7, 5, 3, 1, 10.0, "N", day), (7, 5, 3, 1, 10.0, "A", day), (7, None, 3, 2, 1.0, None, None),
             (7, 6, 3, 1, None, "R", day), (None, 1, None, 1, 1.0, "R", day)]
    spark.createDataFrame(lines, "l_suppkey long, l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
                          "l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r._id: (r.mobile, json.loads(r.moxie_carrier_originalInfo)) for r in fx.call_docs(spark, str(tmp_path)).collect()}
    text = {"peer_number": "+86 13800", "time": "1996-03-13 00:00:00"}
    first = {"details_id": "5-1", "fee": 1} | text
    assert got["0" * 13 + "7"] == ("13900000003", {"calls": [
        {"items": [{"details_id": "2", "dial_type": "MISS", "duration": "1", "fee": 2, "peer_number": "+86 13800"}]},
        {"items": [first | {"dial_type": "DIALED", "duration": "10"}, first | {"dial_type": "MISS", "duration": "10"},
                   first | {"dial_type": "MISS", "duration": "9"}]},
        {"items": [{"details_id": "6-1", "dial_type": "DIAL", "fee": 1} | text]}]})
    assert got[None] == (None, {"calls": [{"items": [
        {"details_id": "1-1", "dial_type": "DIAL", "duration": "1", "fee": 1, "time": "1996-03-13 00:00:00"}]}]})
