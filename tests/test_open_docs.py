"""Documents without a declared schema: validity, fields, schema, cells, maps, and agreement with the declared parse."""

import pytest
from pyspark.sql import functions as F

from cellsmith.operators import nested as N
from cellsmith.operators import open_docs as OD

WHOLE = ['{"a":1,"b":"x","c":null,"d":[1,2.50],"e":{"q":true}}', "{}", ' {"a":"1"} ']
FAULTY = ['{"a":1} tail', '{"a":1}{}', '{"a":1},{}', "{bad", "", "[1]", "3", "null", '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}', None]


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


def test_valid_and_faulty(spark):
    got = {r.id: r._valid for r in OD.parse_open(_docs(spark, WHOLE + FAULTY), "t").select("id", "_valid").collect()}
    assert got == {i: i < len(WHOLE) for i in range(len(WHOLE + FAULTY))}


def test_cells_of_open_fields(spark):
    docs = OD.parse_open(_docs(spark, WHOLE + FAULTY), "t").withColumn("k", F.when(F.col("id") != 2, F.col("id")))
    got = sorted((r.rowkey, r.qualifier, r.value) for r in OD.open_cells(docs, "k").collect())
    assert got == [("0", "a", "1"), ("0", "b", "x"), ("0", "c", ""), ("0", "d", "[1,2.5]"), ("0", "e", '{"q":true}')]
    assert sorted(r.qualifier for r in OD.open_cells(docs, "k", drop=("a", "c")).collect()) == ["b", "d", "e"]


def test_profile_and_schema(spark):
    docs = OD.parse_open(_docs(spark, WHOLE + FAULTY), "t")
    got = {(r.field, r.kind): r.documents for r in OD.field_profile(docs).collect()}
    assert got == {("a", "BIGINT"): 1, ("a", "STRING"): 1, ("b", "STRING"): 1, ("c", "VOID"): 1, ("d", "ARRAY"): 1, ("e", "OBJECT"): 1}
    assert OD.open_schema(docs).startswith("OBJECT<a: VARIANT, b: STRING, c: VOID, d: ARRAY<")
    assert OD.field_profile(docs.where("id < 0")).count() == 0


def test_clashing_names(spark):
    docs = _docs(spark, ['{"key":"v","value":1,"pos":2}']).withColumn("key", F.lit("K")).withColumn("value", F.lit(0)).withColumn("pos", F.lit(0))
    got = sorted((r.rowkey, r.qualifier, r.value) for r in OD.open_cells(OD.parse_open(docs, "t"), "id").collect())
    assert got == [("0", "key", "v"), ("0", "pos", "2"), ("0", "value", "1")]


def test_maps_and_back(spark):
    rows = spark.createDataFrame([("r", {"b": "2", "a": None}), ("s", {}), ("t", None), (None, {"a": "1"})], "k string, m map<string,string>")
    cells = OD.map_cells(rows, "k", "m")
    assert sorted((r.rowkey, r.family, r.qualifier, r.value) for r in cells.collect()) == [("r", "cf", "a", ""), ("r", "cf", "b", "2")]
    twice = cells.unionByName(cells.withColumn("value", F.lit("9")))
    assert [(r.rowkey, r.fields) for r in OD.row_maps(twice).collect()] == [("r", {"a": "9", "b": "9"})]


@pytest.mark.parametrize("text", [
    '{"calls":[{"items":[{"details_id":"1","fee":3,"time":"t"},{"fee":"12","peer_number":null}]},{"items":[]}]}',
    '{"calls":[]}', '{"calls":[{"items":[{}]},{}]}', '{"calls":3}', '{"calls":[{"items":1}]}', "{}", "{bad", "", '{"calls":[{"items":[{}]}]} x',
])
def test_calls_as_with_a_schema(spark, text):
    df = spark.createDataFrame([("d", "139", text)], "_id string, mobile string, p string")
    declared = N.flatten_calls(df, payload="p")
    assert OD.flatten_open_calls(df, "p").collect() == declared.collect()
    assert OD.flatten_open_calls(df, "p").columns == declared.columns
