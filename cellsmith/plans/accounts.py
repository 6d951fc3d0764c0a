"""Accounts of the whole jobs: what was read, rejected, repeated and written adds up.

Rows are counted by ``observe`` in the writes the jobs make anyway.  Every
observed place is in the last stage of its write, where Spark counts each
task once however often it ran, so a lost executor changes no count.  Nothing
is observed below a range exchange, whose sampling reads its input twice; the input
rows of W2 and W3 are counted by one aggregate over the columns that decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellsmith.functions import columns as C
from cellsmith.plans import jobs
from cellsmith.session import materialize
from cellsmith.sinks.files import write_sorted_cells

ACCOUNT = "job string, measure string, n long"


def _write(cells: DataFrame, staging: str, head: str) -> tuple[int, int]:
    """Write ``cells``; ``(rows, cells)`` written, a row being a cell of the qualifier ``head``."""
    seen = Observation()
    counted = cells.observe(seen, F.count(F.lit(1)).alias("cells"), F.count_if(F.col("qualifier") == head).alias("rows"))
    write_sorted_cells(counted, staging, presorted=True)
    return seen.get["rows"], seen.get["cells"]


def _account(spark: SparkSession, job: str, width: int, **n: int) -> DataFrame:
    """The account as rows; one that does not add up is an error, for then rows were lost."""
    if n["read"] != n["rejected"] + n["repeated"] + n["written"] or min(n.values()) < 0 or n["cells"] != width * n["written"]:
        raise ValueError(f"the account of {job} does not add up: {n}")
    return spark.createDataFrame([(job, k, int(v)) for k, v in n.items()], ACCOUNT)


def write_calls(docs: DataFrame, staging: str, payload: str = jobs.PAYLOAD) -> DataFrame:
    """W1 with its account: ``job, measure, n``.

    ``read`` counts the call items and the documents that are rejected whole; ``repeated`` the items that
    keep-first drops; ``documents`` all documents and ``without_payload`` those without one.
    The items and their reasons are written once, and counted in that write; rejects are
    counted by reason, a row each.
    """
    spark = docs.sparkSession
    read, kept = Observation(), Observation()
    few = docs.select("_id", "mobile", payload).observe(
        read, F.count(F.lit(1)).alias("documents"), F.count_if(F.col(payload).isNull()).alias("without_payload"))
    keyed = jobs.keyed_calls(few, payload).observe(
        kept, F.count(F.lit(1)).alias("read"), F.count("reason").alias("rejected"))
    keyed = materialize(keyed, "call-items")
    cells = jobs.cells_of_calls(keyed)
    rows, n_cells = _write(cells, staging, "id")
    reasons = jobs.split_calls(keyed)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    total = kept.get["read"] - kept.get["rejected"]
    account = _account(spark, "calls", len(jobs.CALL_FIELDS), read=kept.get["read"], rejected=kept.get["rejected"],
                       repeated=total - rows, written=rows, cells=n_cells)
    more = spark.createDataFrame([("calls", k, int(read.get[k])) for k in ("documents", "without_payload")], ACCOUNT)
    by_reason = reasons.select(F.lit("calls").alias("job"), F.concat(F.lit("rejected: "), "reason").alias("measure"), "n")
    return account.unionByName(more).unionByName(by_reason)


def write_raw(docs: DataFrame, staging: str) -> DataFrame:
    """W2 as published, with its account: too short times are ``rejected``, documents that a newer one of
    the same key replaces are ``repeated``."""
    kept = C.min_length(F.col("create_time"), jobs.RAW_MIN_TIME_LENGTH)
    n = docs.agg(F.count(F.lit(1)).alias("read"), F.count_if(kept).alias("kept")).first()
    rows, cells = _write(jobs.raw_docs_latest(docs), staging, "_id")
    return _account(docs.sparkSession, "raw", len(jobs.RAW_FIELDS), read=n["read"], rejected=n["read"] - n["kept"],
                    repeated=n["kept"] - rows, written=rows, cells=cells)


def write_contacts(df: DataFrame, staging: str, order_by=("ord",), exclude=("ord",)) -> DataFrame:
    """W3 with its account: contacts without a phone number are ``rejected``; every other contact has a
    key of its own, so none is ``repeated``."""
    n = df.agg(F.count(F.lit(1)).alias("read"), F.count("phoneNo").alias("kept")).first()
    rows, cells = _write(jobs.contacts_to_cells(df, order_by, exclude), staging, "phoneNo")
    width = len([c for c in df.columns if c not in exclude])
    return _account(df.sparkSession, "contacts", width, read=n["read"], rejected=n["read"] - n["kept"],
                    repeated=0, written=rows, cells=cells)
