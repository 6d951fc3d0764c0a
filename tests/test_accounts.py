"""Accounts: the counts of a job follow from its input, and one that does not add up fails."""

import pytest
from pyspark.sql import functions as F

from cellsmith.plans import accounts as A
from cellsmith.session import scratch_path


def _item(i, peer="1380001", time="2017-12-20 16:42:10", fee="3"):
    return f'{{"details_id":"{i}","dial_type":"DIAL","fee":"{fee}","peer_number":"{peer}","time":"{time}"}}'


def _doc(*items):
    return '{"calls":[{"items":[' + ",".join(items) + "]}]}"


def _n(df):
    return {r.measure: r.n for r in df.collect()}


def test_calls(spark):
    rows = [("1", "139", _doc(_item(1), _item(2), _item(3, peer="5"), _item(4, fee="x"), _item(5, time="?"))),
            ("2", "139", _doc(_item(6))), ("3", None, _doc(_item(7))), ("4", "139", "{bad"), ("5", "139", None), ("6", "139", '{"calls":[]}')]
    docs = spark.createDataFrame(rows, "_id string, mobile string, moxie_carrier_originalInfo string").withColumn("n", F.lit(1))
    path = scratch_path(spark, "account")
    got = _n(A.write_calls(docs, path))
    assert got == {"read": 8, "rejected": 4, "repeated": 2, "written": 2, "cells": 18, "documents": 6, "without_payload": 1,
                   "rejected: fee": 1, "rejected: time": 1, "rejected: id_or_mobile": 1, "rejected: payload": 1}
    assert spark.read.parquet(path).count() == 18


def test_hot_key_counts_once(spark):
    # One key of many rows is numbered by itself first; its rows are still counted once.
    docs = spark.range(60).select(
        F.col("id").cast("string").alias("_id"), F.lit("139").alias("mobile"),
        F.concat(F.lit('{"calls":[{"items":['), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(
            F.lit('{"details_id":"1","fee":1,"time":"2017-12-20 16:42:10","peer_number":"'), (i + F.col("id") * 50).cast("string"), F.lit('"}'))), ","),
            F.lit("]}]}")).alias("moxie_carrier_originalInfo")).repartition(6)
    got = _n(A.write_calls(docs, scratch_path(spark, "account")))
    assert (got["read"], got["rejected"], got["written"], got["repeated"]) == (6000, 0, 3050, 2950)


def test_empty(spark):
    docs = spark.createDataFrame([], "_id string, mobile string, moxie_carrier_originalInfo string")
    assert set(_n(A.write_calls(docs, scratch_path(spark, "account"))).values()) == {0}
    contacts = spark.createDataFrame([], "ord long, phoneNo string, tel string, name string")
    assert set(_n(A.write_contacts(contacts, scratch_path(spark, "account"))).values()) == {0}


def test_must_add_up(spark):
    with pytest.raises(ValueError, match="does not add up"):
        A._account(spark, "x", 3, read=5, rejected=1, repeated=0, written=3, cells=9)
