"""Property tests: column functions against plain-Python models of the
reference's semantics, on generated text; job invariants."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellsmith.functions import columns as C
from cellsmith.plans import jobs
from cellsmith.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def model_phone(s):
    if s is None:
        return None
    for part in (" ", "\u00a0", "\uff0d", "-", "\uff0b86", "+86"):
        s = s.replace(part, "")
    return s


def model_compact(s):
    if s is None:
        return None
    m = re.match(r"(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})", s)
    if not m:
        return None
    y, mo, d, h, mi, se = (int(g) for g in m.groups())
    try:
        dt.datetime(y, mo, d, h, mi, se)
    except ValueError:
        return None
    return f"{y:04d}{mo:02d}{d:02d}{h:02d}{mi:02d}{se:02d}"


phone_text = st.lists(st.sampled_from(["1", "3", "8", "6", " ", "\u00a0", "\uff0d", "-", "+", "\uff0b", "86", "+86"]),
                      max_size=12).map("".join)
num = st.integers(min_value=0, max_value=99)
time_text = st.builds(
    lambda y, mo, d, h, mi, s, pad, tail: (
        f"{y:04d}-{mo:0{pad}d}-{d:0{pad}d} {h:0{pad}d}:{mi:0{pad}d}:{s:0{pad}d}{tail}"),
    st.integers(1990, 2030), st.integers(0, 14), st.integers(0, 32), st.integers(0, 25), num, num,
    st.sampled_from([1, 2]), st.sampled_from(["", ".5", ".123", "x", " 1"]))


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), phone_text), min_size=1, max_size=30))
def test_normalize_phone_model(spark, values):
    assert run(spark, C.normalize_phone, values) == [model_phone(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(time_text, st.text(max_size=25)), min_size=1, max_size=30))
def test_compact_datetime_model(spark, values):
    assert run(spark, C.compact_datetime, values) == [model_compact(v) for v in values]


def test_cell_count_is_rows_times_columns(spark):
    docs = fx.raw_docs(spark, SF)
    rows = jobs.raw_rows(docs)
    assert jobs.raw_docs_to_cells(docs).count() == rows.count() * len(jobs.RAW_FIELDS)


def test_raw_job_independent_of_session_zone(spark):
    docs = fx.raw_docs(spark, SF)
    utc = sorted(tuple(r) for r in jobs.raw_docs_to_cells(docs).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = sorted(tuple(r) for r in jobs.raw_docs_to_cells(fx.raw_docs(spark, SF)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny
    suffixes = {r[0].split("_")[-1] for r in utc}
    assert any(len(s) == 9 for s in suffixes) and any(len(s) == 10 for s in suffixes)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "hot"]), st.integers(0, 50)), min_size=1, max_size=120),
       st.sampled_from([1, 3, 10]))
def test_sequence_key_properties(spark, data, parts):
    from cellsmith.operators import keys as K

    rows = [(b, o, i) for i, (b, o) in enumerate(data)]
    df = spark.createDataFrame(rows, "base string, o long, i long")
    got = {r["i"]: r["rowkey"] for r in K.sequence_key(df, "base", ["o", "i"], "rowkey", "_",
                                                       parts=parts).collect()}
    expect = {}
    for base in {b for b, _, _ in rows}:
        members = sorted((o, i) for b, o, i in rows if b == base)
        for n, (_, i) in enumerate(members):
            expect[i] = f"{base}_{n}"
    assert got == expect
