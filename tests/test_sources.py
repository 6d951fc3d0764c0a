"""Sources: scans, preview, sample messages."""

from cellsmith.session import scratch_path
from cellsmith.sources import fixtures as fx
from cellsmith.sources import tables as TB

SF = "/root/testdata/sf0.001"


def test_scans_and_preview(spark):
    orders = TB.scan_parquet(spark, f"{SF}/orders.parquet", ["o_orderkey"])
    assert orders.columns == ["o_orderkey"]
    TB.register_table(orders, "cellsmith_orders_t")
    assert TB.scan_table(spark, "cellsmith_orders_t").count() == orders.count()
    assert TB.preview(orders, 7).count() == 7
    row = TB.preview_count(orders, 10).first()
    assert row["rows"] == orders.count() and row["preview_rows"] == 10


def test_scan_documents_formats(spark):
    path = scratch_path(spark, "t-docs-json")
    fx.call_docs(spark, SF).write.json(path)
    schema = "_id string, mobile string, moxie_carrier_originalInfo string"
    a = TB.scan_documents(spark, schema, path)
    b = TB.scan_documents(spark, schema, path, fmt="json")
    assert a.count() == b.count() == fx.call_docs(spark, SF).count()
    assert a.columns == ["_id", "mobile", "moxie_carrier_originalInfo"]


def test_sample_messages(spark):
    o = fx.read_table(spark, SF, "orders")
    nums = TB.generate_numbers(o, "o_orderkey").orderBy("i").first()
    txt = TB.generate_text(o, "o_orderkey").orderBy("i").first()
    assert nums["value"] == "1860123458" + str(nums["i"])
    assert txt["value"] == f"hello kafka.javaapi.producer message {txt['i']}"


def test_lines_that_are_no_document_are_rejects(spark):
    path = scratch_path(spark, "t-lines")
    lines = ['{"a":1,"b":"x"}', '{"a":1', 'text', '{"a":"no number","b":"x"}', '{"b":"y"}', "[]x"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = TB.scan_documents_checked(spark, "a bigint, b string", path)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (None, "y")]
    assert sorted(r.line for r in bad.collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])
    # counts see the same rows, though no field is asked for
    assert good.count() == 2 and bad.count() == 4


def test_bucketed_table_is_replaced_and_joined_by_name(spark):
    name = "cellsmith_bucketed_t"
    for n in (5, 50):
        TB.save_bucketed(spark.range(n).selectExpr("id % 7 AS k", "id"), name, "k", 4, scratch_path(spark, "t-bucketed"))
    a = TB.scan_table(spark, name)
    assert a.count() == 50
    joined = a.hint("merge").join(TB.scan_table(spark, name, ["k"]).distinct().hint("merge"), "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 50
