"""Whole jobs: ranges never change results; rejects (FIXTURES.md C)."""

import json

import pytest
from pyspark.sql import functions as F

from cellsmith.plans import jobs
from cellsmith.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def in_order(cells):
    """Partitions hold increasing, disjoint key ranges and are sorted inside."""
    parts = cells.rdd.mapPartitions(lambda it: [[(r[0].encode(), r[2].encode()) for r in it]]).collect()
    flat = [k for p in parts for k in p]
    return flat == sorted(flat) and len(parts)


def test_calls_to_cells_in_order_whatever_the_ranges(spark):
    docs = fx.call_docs(spark, SF)
    one, _ = jobs.calls_to_cells(docs, parts=1)
    many, _ = jobs.calls_to_cells(docs, parts=23)
    assert rows(one) == rows(many)
    assert in_order(many) > 5


def test_keys_with_an_underscore_are_sorted_when_finished(spark):
    docs = fx.call_docs(spark, SF).withColumn("mobile", F.concat(F.substring("mobile", 1, 3), F.lit("_"), F.substring("mobile", 4, 9)))
    cells, _ = jobs.calls_to_cells(docs)
    assert in_order(cells) and cells.count() == jobs.calls_to_cells(fx.call_docs(spark, SF))[0].count()


def test_contacts_to_cells_in_order_whatever_the_ranges(spark):
    c = fx.contacts(spark, SF)
    hot = c.withColumn("phoneNo", F.when(F.col("ord") % 3 == 0, F.lit("777")).otherwise(F.col("phoneNo"))).withColumn("tel", F.lit("5"))
    for df in (c, hot):
        cells = jobs.contacts_to_cells(df, parts=13)
        assert rows(cells) == rows(jobs.contacts_to_cells(df, parts=1))
        assert in_order(cells) > 5
    odd = c.withColumn("tel", F.lit("5_6"))
    assert in_order(jobs.contacts_to_cells(odd))


def _doc(calls):
    return json.dumps({"calls": calls})


def _item(peer="+86 138", time="2017-12-20 16:42:10", dial="DIAL", fee=None):
    it = {"details_id": "d", "dial_type": dial, "duration": "5", "peer_number": peer, "time": time}
    if fee is not None:
        it["fee"] = fee
    return it


@pytest.fixture(scope="module")
def edge_docs(spark):
    data = [
        ("00000000000a", "13800000001", _doc([{"items": [_item(), _item(peer="+86 139", fee="12")]}])),
        ("00000000000b", "13800000002", "{bad"),
        ("00000000000c", "13800000003", "{}"),
        ("00000000000d", "13800000004", _doc([{}])),
        ("00000000000e", "13800000005", _doc([])),
        ("00000000000f", None, _doc([{"items": [_item()]}])),
        ("00000000000g", "13800000006", _doc([{"items": [_item(time="2017-13-40 16:42:10"), _item(peer=None)]}])),
        ("00000000000h", "13800000007", None),
        ("00000000000j", "13800000008", _doc([{"items": [_item()]}]) + " trailing"),
        ("00000000000k", "13800000008", _doc([{"items": [_item()]}]) + "] x"),
        ("00000000000l", "13800000008", "[" + _doc([{"items": [_item()]}]) + "]"),
        ("00000000000m", "13800000009", _doc([{"items": [_item(fee="12.5")]}, {"items": []}])),
        ("00000000000n", "13800000009", ""),
        ("00000000000i", "13800000001", _doc([{"items": [_item(), _item(time="2017-12-20 16:42:10.5", fee=2)]}])),
    ]
    return spark.createDataFrame(data, "_id string, mobile string, moxie_carrier_originalInfo string")


def test_call_rejects(spark, edge_docs):
    cells, rejects = jobs.calls_to_cells(edge_docs)
    reasons = sorted((r["id"], r["reason"]) for r in rejects.collect())
    assert reasons == [
        ("00000000000b", "payload"), ("00000000000c", "payload"), ("00000000000d", "payload"),
        ("00000000000f", "id_or_mobile"), ("00000000000g", "peer_number"), ("00000000000g", "time"),
        ("00000000000j", "payload"), ("00000000000k", "payload"), ("00000000000l", "payload"),
        ("00000000000m", "fee"), ("00000000000n", "payload"),
    ]
    keys = sorted({r["rowkey"] for r in cells.collect()})
    # doc a: two items, distinct peers; doc i (same mobile): first item repeats doc a's first
    # (same peer and time) and is dropped, the .5 item has another time text and stays
    assert keys == ["10000000831_20171220164210_0_0", "10000000831_20171220164210_0_1",
                    "10000000831_20171220164210_0_2"]
    fee = sorted(r["value"] for r in cells.collect() if r["qualifier"] == "fee")
    assert fee == ["0", "12", "2"]


def test_call_strict_mode(spark, edge_docs):
    with pytest.raises(ValueError):
        jobs.calls_to_cells(edge_docs, strict=True)


def test_contact_without_phone_is_rejected(spark):
    c = spark.createDataFrame([(1, "123", None, "a"), (2, None, "+86 9", "b")],
                              "ord long, phoneNo string, tel string, name string")
    cells = jobs.contacts_to_cells(c)
    assert {r["rowkey"] for r in cells.collect()} == {"321_noTel_0"}
    assert [r["ord"] for r in jobs.contact_rejects(c).collect()] == [2]
    assert jobs.contact_rows(c).count() == 1
    with pytest.raises(ValueError):
        jobs.contacts_to_cells(c, strict=True)


def test_raw_rows_with_timestamp_create_time(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [("a", dt.datetime(2018, 4, 24, 22, 13, 20), "13800000001", None, None, None, None)],
        "_id string, create_time timestamp_ntz, mobile string, moxie_carrier_originalInfo string, "
        "successFlag string, task_id string, update_time string")
    row = jobs.raw_rows(df).first()
    assert row["create_time"] == "2018-04-24 22:13:20.000"
    assert row["rowkey"] == "10000000831_1000000000"


def test_jobs_are_independent_of_input_partitioning(spark):
    docs = fx.call_docs(spark, SF)
    a, _ = jobs.calls_to_cells(docs)
    b, _ = jobs.calls_to_cells(docs.repartition(5, "mobile"))
    c, _ = jobs.calls_to_cells(docs.repartition(3).orderBy("_id", ascending=False))
    assert rows(a) == rows(b) == rows(c)
    contacts = fx.contacts(spark, SF)
    assert rows(jobs.contacts_to_cells(contacts)) == rows(jobs.contacts_to_cells(contacts.repartition(7)))


def test_null_tel_cell_choice(spark):
    c = spark.createDataFrame([(1, "123", None, "a")], "ord long, phoneNo string, tel string, name string")
    tel = [r["value"] for r in jobs.contacts_to_cells(c).collect() if r["qualifier"] == "tel"]
    assert tel == ["noTel"]
    tel = [r["value"] for r in jobs.contacts_to_cells(c, null_tel_cell="").collect() if r["qualifier"] == "tel"]
    assert tel == [""]
    assert [r["tel"] for r in jobs.contact_rows(c).collect()] == [""]
    assert [r["tel"] for r in jobs.contact_rows(c, null_tel_cell="noTel").collect()] == ["noTel"]


def test_flatten_calls_from_payload(spark):
    from cellsmith.operators import nested as N

    docs = fx.call_docs(spark, SF)
    a = N.flatten_calls(docs, payload="moxie_carrier_originalInfo")
    b = N.flatten_calls(N.parse_calls(docs), "doc", valid="_valid")
    assert rows(a) == rows(b) and a.count() == fx.read_table(spark, SF, "lineitem").count()


def test_contacts_with_rejects(spark):
    c = spark.createDataFrame([(1, "123", None, "a"), (2, None, "9", "b")],
                              "ord long, phoneNo string, tel string, name string")
    cells, rejects = jobs.contacts_to_cells(c, with_rejects=True)
    assert cells.count() == 3 and [r["ord"] for r in rejects.collect()] == [2]


def test_documents_are_parsed_once_for_cells_and_rejects(spark, edge_docs):
    cells, rejects = jobs.calls_to_cells(edge_docs, once=True)
    for df in (cells, rejects):
        assert "from_json" not in df._jdf.queryExecution().executedPlan().toString()
    again = jobs.calls_to_cells(edge_docs, once=False)
    assert rows(cells) == rows(again[0]) and sorted(map(str, rejects.collect())) == sorted(map(str, again[1].collect()))
