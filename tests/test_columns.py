"""Column functions on literal edge rows (FIXTURES.md part C)."""

from pyspark.sql import functions as F

from cellsmith.functions import columns as C


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_normalize_phone(spark):
    got = one(spark, C.normalize_phone,
              ["+86 138-0013 8000", "＋86139", "13+86900", "+8＋8661", "13 8－0", None])
    assert got == ["13800138000", "139", "13900", "1", "1380", None]


def test_compact_datetime(spark):
    got = one(spark, C.compact_datetime,
              ["2017-12-20 16:42:10", "2017-12-20 16:42:10.5", "2017-1-2 3:4:5",
               "2017-13-40 16:42:10", "2017-12-20 16:42", "2017-02-30 01:01:01", None])
    assert got == ["20171220164210", "20171220164210", "20170102030405", None, None, None, None]
    assert one(spark, C.compact_datetime_short, ["2017-12-20 16:42:10"]) == ["171220164210"]


def test_compact_datetime_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, C.compact_datetime, ["2018-03-11 02:30:00"]) == ["20180311023000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_suffix(spark):
    def suffix(c):
        return (F.lit(C.MAX_EPOCH) - C.epoch_seconds(c)).cast("string")

    got = one(spark, suffix, ["2018-04-24 22:13:20.000", "2018-04-24 22:13:21.999",
                              "not a time 2018-04-24 22:13:21.999", "2018-04-24 22:13:21"])
    assert got == ["1000000000", "999999999", "2524579200", None]


def test_epoch_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, C.epoch_seconds, ["1970-01-01 08:00:01.000"]) == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dial_peer_product(spark):
    assert one(spark, C.dial_code, ["DIAL", "DIALED", "dial", None]) == ["0", "1", "2", "2"]
    assert one(spark, C.peer_tail, ["12345", "12", ""]) == ["2345", "1200", "0000"]
    assert one(spark, C.product_type, ["a" * 12, "a" * 14, "a" * 13, None]) == ["1", "2", "0", None]


def test_is_numeric(spark):
    assert one(spark, C.is_numeric, ["12", "1a", "", "12\n", None]) == [True, False, False, False, False]


def test_fee_text(spark):
    assert one(spark, C.fee_text, [None, "12", "2"]) == ["0", "12", "2"]
    assert one(spark, C.fee_text, ["12.5", "abc", "99999999999", ""]) == [None, None, None, None]


def test_contact_key(spark):
    df = spark.createDataFrame([("123", None), ("123", ""), ("123", "+86 9")], "p string, t string")
    got = [r[0] for r in df.select(C.contact_key("p", "t")).collect()]
    assert got == ["321_noTel", "321_", "321_9"]


def test_java_string_hash(spark):
    words = ["", "a", "hello", "1234-7", "details-99999-7"]

    def jhash(s):
        h = 0
        for ch in s:
            h = (31 * h + ord(ch)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= (1 << 31) else h

    assert one(spark, C.java_string_hash, words) == [jhash(w) for w in words]


def test_messages(spark):
    df = spark.createDataFrame([(7, "k", "v")], "o long, k string, v string")
    assert df.select(C.format_message("o", "k", "v")).first()[0] == "offset = 7, key = k, value = v"
    df = spark.createDataFrame([(3,)], "i long")
    assert df.select(C.sample_number("i"), C.sample_text("i")).first() == (
        "18601234583", "hello kafka.javaapi.producer message 3")


def test_recency_key_pad(spark):
    df = spark.createDataFrame([("123", "2018-04-24 22:13:21.999"), ("123", "2018-04-24 22:13:20.000")],
                               "m string, t string")
    plain = [r[0] for r in df.select(C.recency_key("m", "t")).collect()]
    padded = [r[0] for r in df.select(C.recency_key("m", "t", pad=10)).collect()]
    assert plain == ["321_999999999", "321_1000000000"]
    # unpadded text puts the older row first; padded restores newest first
    assert sorted(plain) == ["321_1000000000", "321_999999999"]
    assert padded == ["321_0999999999", "321_1000000000"] and sorted(padded) == padded
