"""Inputs of the jobs, derived from the driver tables (FIXTURES.md part B).

The reference ships no data; these derivations give its record shapes from
the TPC-H-ish tables so that every job's work grows with the tables.
Each is a lazy DataFrame.  The DuckDB forms used by the oracle are in
``cellsmith.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _lpad_num(c, n) -> F.Column:
    return F.lpad(c.cast("string"), n, "0")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address-book rows from ``orders`` (B1): ``ord, phoneNo, tel, name``.

    ``ord`` (the order key) is the tie-break only.  tel takes five shapes by
    ``o_orderkey % 5``: null, ``+86 138-n``, full-width ``\uff0b86138\uff0dn``,
    ``138<no-break space>n`` and empty; the middle three normalise alike.
    """
    o = read_table(spark, sf_dir, "orders")
    n = _lpad_num(F.col("o_custkey") % 97, 8)
    r = F.col("o_orderkey") % 5
    tel = (
        F.when(r == 0, F.lit(None).cast("string"))
        .when(r == 1, F.concat(F.lit("+86 138-"), n))
        .when(r == 2, F.concat(F.lit("\uff0b86138\uff0d"), n))
        .when(r == 3, F.concat(F.lit("138\u00a0"), n))
        .otherwise(F.lit(""))
    )
    return o.select(
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("186"), _lpad_num(F.col("o_custkey"), 8)).alias("phoneNo"),
        tel.alias("tel"),
        F.col("o_orderpriority").alias("name"),
    )


def contacts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``contacts`` without a phone number on every 17th order key."""
    return contacts(spark, sf_dir).withColumn(
        "phoneNo", F.when(F.col("ord") % 17 != 0, F.col("phoneNo")))


def faulty_call_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One carrier document per order, by ``o_orderkey % 13``: no payload,
    malformed, ``{}``, text behind the document, a call without items, no
    calls, no mobile, no peer number, a bad time, a fee that is no integer, no
    fee and dial type, a fractional time with text fee, short peer, location
    and 13-character id, empty text."""
    o = read_table(spark, sf_dir, "orders")
    r = F.col("o_orderkey") % 13

    def doc(time="2017-12-20 16:42:10", peer='"+86 138-0001"', rest=',"dial_type":"DIAL","fee":3'):
        return F.concat(
            F.lit('{"calls":[{"items":[{"details_id":"'), F.col("o_orderkey").cast("string"),
            F.lit(f'","duration":"5","peer_number":{peer},"time":"{time}"{rest}}}]}}]}}'))

    payload = (
        F.when(r == 0, F.lit(None).cast("string")).when(r == 1, F.lit("{bad")).when(r == 2, F.lit("{}"))
        .when(r == 3, F.concat(doc(), F.lit(" trailing"))).when(r == 4, F.lit('{"calls":[{}]}'))
        .when(r == 5, F.lit('{"calls":[]}')).when(r == 7, doc(peer="null"))
        .when(r == 8, doc(time="2017-13-40 16:42:10"))
        .when(r == 9, doc(rest=',"dial_type":"DIALED","fee":"12.5"')).when(r == 10, doc(rest=""))
        .when(r == 11, doc("2017-12-20 16:42:10.5", '"+86 1"', ',"dial_type":"DIALED","fee":"12","location":"x"'))
        .when(r == 12, F.lit("")).otherwise(doc()))
    return o.select(
        F.when(r == 11, _lpad_num(F.col("o_orderkey"), 13)).otherwise(_lpad_num(F.col("o_orderkey"), 14)).alias("_id"),
        F.when(r != 6, F.concat(F.lit("139"), _lpad_num(F.col("o_custkey"), 8))).alias("mobile"),
        payload.alias("moxie_carrier_originalInfo"))


def call_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier documents (B2): ``_id, mobile, moxie_carrier_originalInfo``.

    One document per supplier, one call per order, one item per line, both
    lists in key order.  A document is one input row: its size is that of
    one supplier's lines (about 600 at every scale of the generator).  The lines go
    through one exchange, as the few columns the items are made of; texts
    are made from a supplier's sorted lines behind it.
    """
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    # In the order of the items' texts, which decides between repeated keys.
    line = F.struct(
        "l_orderkey", "l_linenumber", F.when(flag == "R", 0).when(flag == "A", 1).otherwise(2).cast("byte").alias("dial"),
        F.col("l_quantity").cast("long").cast("string").alias("duration"),
        (F.col("l_partkey") % 3).cast("string").alias("peer"), F.col("l_shipdate").alias("day"))
    lines = li.groupBy("l_suppkey").agg(F.sort_array(F.collect_list(line)).alias("_lines"))

    def starts(i):  # the first line of an order
        before, here = F.get("_lines", i - 1)["l_orderkey"], F.get("_lines", i)["l_orderkey"]
        return (i == 0) | ~before.eqNullSafe(here)

    lines = lines.withColumn("_first", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), starts))

    def item(x):
        return F.struct(
            F.concat_ws("-", x["l_orderkey"].cast("string"), x["l_linenumber"].cast("string")).alias("details_id"),
            F.element_at(F.array(*map(F.lit, ("DIAL", "DIALED", "MISS"))), x["dial"] + 1).alias("dial_type"),
            x["duration"].alias("duration"), x["l_linenumber"].alias("fee"),
            F.concat(F.lit("+86 1380"), x["peer"]).alias("peer_number"), x["day"].cast("string").alias("time"))

    def call(at, k):
        end = F.coalesce(F.get("_first", k + 1), F.size("_lines"))
        return F.struct(F.transform(F.slice("_lines", at + 1, end - at), item).alias("items"))

    odd = (F.col("l_suppkey") % 2) == 1
    return lines.select(
        F.when(odd, _lpad_num(F.col("l_suppkey"), 14)).otherwise(_lpad_num(F.col("l_suppkey"), 12)).alias("_id"),
        F.concat(F.lit("139"), _lpad_num(F.expr("l_suppkey div 2"), 8)).alias("mobile"),
        # Never null; said so, a test for null does not make the text a second time.
        F.coalesce(F.to_json(F.struct(F.transform("_first", call).alias("calls"))), F.lit(""))
        .alias("moxie_carrier_originalInfo"),
    )


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw carrier rows from ``events`` (B3), all text columns.

    ``create_time`` is 23-character ``yyyy-MM-dd HH:mm:ss.SSS`` text, shifted
    back by 0/1000/2000/3000 days so that recency suffixes of 9 and 10 digits
    occur; every 7th row is too short, every 11th unparseable, every 13th
    mobile is null.
    """
    e = read_table(spark, sf_dir, "events")
    t = F.col("ts") + F.make_dt_interval(days=-((F.col("event_id") % 4) * 1000).cast("int"))
    s = t.cast("string")
    s = F.when(F.instr(s, ".") > 0, s).otherwise(F.concat(s, F.lit(".")))
    m = F.substring(F.rpad(s, 26, "0"), 1, 23)
    eid = F.col("event_id")
    return e.select(
        F.when(eid % 2 == 0, _lpad_num(eid, 12)).otherwise(_lpad_num(eid, 14)).alias("_id"),
        F.when(eid % 7 == 0, F.substring(m, 1, 19))
        .when(eid % 11 == 0, F.concat(F.lit("not a time "), m))
        .otherwise(m).alias("create_time"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("137"), _lpad_num(F.col("user_id"), 8))).alias("mobile"),
        F.col("props").alias("moxie_carrier_originalInfo"),
        F.col("event_type").alias("successFlag"),
        eid.cast("string").alias("task_id"),
        F.lit(None).cast("string").alias("update_time"),
    )


def raw_docs_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_docs`` without a payload where the event is a signup."""
    payload = "moxie_carrier_originalInfo"
    return raw_docs(spark, sf_dir).withColumn(payload, F.when(F.col("successFlag") != "signup", F.col(payload)))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per event; some are cut off, some are no object, some have a text for the number."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    whole = F.to_json(F.struct(eid.alias("event_id"), "event_type", "user_id"))
    return e.withColumn("w", whole).select(
        F.when(eid % 17 == 0, F.expr("substring(w, 1, length(w) - 3)"))
        .when(eid % 19 == 0, F.concat(F.lit("no document "), eid.cast("string")))
        .when(eid % 23 == 0, F.concat(F.lit('{"event_id":"x'), eid.cast("string"), F.lit('","event_type":"a","user_id":1}')))
        .otherwise(F.col("w")).alias("value"))


def open_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, ``_id, payload``, whose fields differ from row to row: names
    made of the event type and the user, and nested, list, null and boolean fields on some.  Some are
    cut off, have text behind them, hold a name twice, are no object, or are null."""
    e = read_table(spark, sf_dir, "events")
    eid, k, kind = F.col("event_id"), F.get_json_object("props", "$.k"), F.col("event_type")
    user = (F.col("user_id") % 50).cast("string")

    def some(n, *parts):
        return F.when(eid % n == 0, F.concat(*parts)).otherwise(F.lit(""))

    head = F.concat(F.lit('{"event_id":'), eid.cast("string"), F.lit(',"'), kind, F.lit('_k":'), k,
                    F.lit(',"u'), user, F.lit('":"'), kind, F.lit('"'))
    whole = F.concat(
        head, some(3, F.lit(',"nested":{"k":'), k, F.lit("}")), some(5, F.lit(',"tags":["a","'), kind, F.lit('"]')),
        some(7, F.lit(',"note":null')), some(11, F.lit(',"flag":true')), F.lit("}"))
    payload = (
        F.when(eid % 29 == 0, head).when(eid % 31 == 0, F.concat(whole, F.lit(" {}"))).when(eid % 37 == 0, F.lit('{"a":1,"a":2}'))
        .when(eid % 41 == 0, F.lit("[1]")).when(eid % 43 == 0, F.lit(None).cast("string")).otherwise(whole))
    return e.select(_lpad_num(eid, 12).alias("_id"), payload.alias("payload"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages from ``events`` (B4): key, value (JSON), topic, partition, offset, timestamp."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(F.struct("user_id", "event_type")).alias("value"),
        F.col("event_type").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
