"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables over their whole extent, directly or
through the fixtures Spark derives from them.  Sinks and streams write under
the session's shared folder (``spark.checkpoint.dir``) and return what they
wrote, read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellsmith.functions import columns as C
from cellsmith.operators import cells as CE
from cellsmith.operators import keys as K
from cellsmith.operators import nested as N
from cellsmith.operators import open_docs as OD
from cellsmith.plans import accounts, jobs
from cellsmith.session import materialize, scratch_path
from cellsmith.sinks import files as S
from cellsmith.sources import fixtures as fx
from cellsmith.sources import tables as TB
from cellsmith.streaming import messages as M

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Fixed parameters of the registered queries.
FILES_PER_BATCH = 2               # pace of the paced streams
STREAM_CUTOFF = "2024-01-16"      # messages before it are the backlog, the rest arrive later
LISTEN_TOPICS = ("click", "purchase")
ORDER_BUCKETS = 16                # buckets of the catalog table
BYTES_PER_BATCH = 40_000          # pace by size
REGION_POINTS = tuple("123456789")  # row keys at which the target of write_split_cells is split
MESSAGE_VALUE_SCHEMA = "user_id bigint, event_type string"


def query(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------------------
# Shared derivations
# ---------------------------------------------------------------------------

def _items(spark, sf_dir):
    items, _ = jobs.call_items(fx.call_docs(spark, sf_dir))
    return items


def _first_items(spark, sf_dir):
    group = ["base", "peer_number", "time"]
    return K.dedup_keep_first(_items(spark, sf_dir).select(*group, *jobs.CALL_ORDER, "details_id"), group, list(jobs.CALL_ORDER))


def _flat(spark, sf_dir):
    docs = fx.call_docs(spark, sf_dir)
    parsed = N.parse_calls(docs)
    return N.flatten_calls(parsed, "doc", keep=("_id", "mobile"), valid="_valid")


def _raw_kept(spark, sf_dir):
    return fx.raw_docs(spark, sf_dir).where(C.min_length(F.col("create_time"), jobs.RAW_MIN_TIME_LENGTH))


def _contact_cells(spark, sf_dir):
    return jobs.contacts_to_cells(fx.contacts(spark, sf_dir))


# ---------------------------------------------------------------------------
# Sources (S1-S5, S11, S12)
# ---------------------------------------------------------------------------

@query("scan_parquet")
def q_scan_parquet(spark, sf_dir):
    return TB.scan_parquet(spark, f"{sf_dir}/orders.parquet",
                           ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("scan_table")
def q_scan_table(spark, sf_dir):
    TB.register_table(fx.read_table(spark, sf_dir, "customer"), "cellsmith_customer")
    return TB.scan_table(spark, "cellsmith_customer", ["c_custkey", "c_name", "c_mktsegment"])


@query("scan_bucketed")
def q_scan_bucketed(spark, sf_dir):
    # A table of the catalog, dealt by the key once and grouped by it without a further exchange.
    name = f"cellsmith_orders_{uuid.uuid4().hex[:12]}"
    orders = fx.read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    TB.save_bucketed(orders, name, "o_custkey", ORDER_BUCKETS, scratch_path(spark, "bucketed"))
    return TB.scan_table(spark, name).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order"))


@query("document_rejects")
def q_document_rejects(spark, sf_dir):
    return _checked_documents(spark, sf_dir)[1]


@query("documents_checked")
def q_documents_checked(spark, sf_dir):
    return _checked_documents(spark, sf_dir)[0]


def _checked_documents(spark, sf_dir):
    path = scratch_path(spark, "document-lines")
    fx.document_lines(spark, sf_dir).write.text(path)
    return TB.scan_documents_checked(spark, "event_id bigint, event_type string, user_id bigint", path)


@query("scan_documents")
def q_scan_documents(spark, sf_dir):
    path = scratch_path(spark, "documents")
    fx.call_docs(spark, sf_dir).write.json(path)
    docs = TB.scan_documents(spark, "_id string, mobile string, moxie_carrier_originalInfo string", path)
    parsed = N.parse_calls(docs)
    return parsed.select(
        "_id", "mobile",
        F.size("doc.calls").cast("long").alias("n_calls"),
        F.aggregate("doc.calls", F.lit(0).cast("long"), lambda acc, c: acc + F.size(c["items"])).alias("n_items"))


@query("preview_count")
def q_preview_count(spark, sf_dir):
    return TB.preview_count(fx.read_table(spark, sf_dir, "orders"))


@query("generate_numbers")
def q_generate_numbers(spark, sf_dir):
    return TB.generate_numbers(fx.read_table(spark, sf_dir, "orders"), "o_orderkey")


@query("generate_text")
def q_generate_text(spark, sf_dir):
    return TB.generate_text(fx.read_table(spark, sf_dir, "orders"), "o_orderkey")


# ---------------------------------------------------------------------------
# Filters (F1-F5)
# ---------------------------------------------------------------------------

@query("filter_not_null")
def q_filter_not_null(spark, sf_dir):
    return fx.raw_docs(spark, sf_dir).where(F.col("mobile").isNotNull()).select("_id", "mobile")


@query("filter_payload")
def q_filter_payload(spark, sf_dir):
    return jobs.with_payload(fx.raw_docs_with_gaps(spark, sf_dir)).select("_id", "mobile", jobs.PAYLOAD)


@query("filter_min_length")
def q_filter_min_length(spark, sf_dir):
    return _raw_kept(spark, sf_dir).select("_id", "create_time")


@query("filter_numeric")
def q_filter_numeric(spark, sf_dir):
    c = fx.contacts(spark, sf_dir)
    return c.where(C.is_numeric(C.normalize_phone(F.col("tel")))).select("ord", "phoneNo", "tel")


@query("cells_drop_named")
def q_cells_drop_named(spark, sf_dir):
    rows = jobs.contact_rows(fx.contacts(spark, sf_dir)).withColumn("main", F.col("name"))
    return CE.to_cells(rows, "rowkey", keep_key=True, drop=[CE.SKIPPED_COLUMN])


@query("cells_skip_key")
def q_cells_skip_key(spark, sf_dir):
    return CE.to_cells(jobs.raw_rows(fx.raw_docs(spark, sf_dir)), "rowkey")


@query("cells_with_key")
def q_cells_with_key(spark, sf_dir):
    return CE.to_cells(jobs.raw_rows(fx.raw_docs(spark, sf_dir)), "rowkey", keep_key=True)


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------

@query("normalize_phone")
def q_normalize_phone(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select("ord", C.normalize_phone(F.col("tel")).alias("tel_norm"))


@query("text_or_empty")
def q_text_or_empty(spark, sf_dir):
    return fx.raw_docs(spark, sf_dir).select(
        "_id", C.text_or_empty(F.col("mobile")).alias("mobile_text"),
        C.text_or_empty(F.col("update_time")).alias("update_text"))


@query("default_text")
def q_default_text(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select("ord", C.default_text(F.col("tel")).alias("tel_text"))


@query("reverse_text")
def q_reverse_text(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select("ord", C.reverse_text(F.col("phoneNo")).alias("phone_rev"))


@query("contact_key")
def q_contact_key(spark, sf_dir):
    return fx.contacts(spark, sf_dir).select("ord", C.contact_key(F.col("phoneNo"), F.col("tel")).alias("rowkey"))


@query("product_type")
def q_product_type(spark, sf_dir):
    return fx.raw_docs(spark, sf_dir).select("_id", C.product_type(F.col("_id")).alias("product"))


@query("epoch_seconds")
def q_epoch_seconds(spark, sf_dir):
    return _raw_kept(spark, sf_dir).select("_id", C.epoch_seconds(F.col("create_time")).alias("epoch"))


@query("recency_key")
def q_recency_key(spark, sf_dir):
    return _raw_kept(spark, sf_dir).select(
        "_id", C.recency_key(F.col("mobile"), F.col("create_time")).alias("rowkey"))


@query("project_fields")
def q_project_fields(spark, sf_dir):
    return jobs.raw_rows(fx.raw_docs(spark, sf_dir))


@query("compact_datetime")
def q_compact_datetime(spark, sf_dir):
    return _flat(spark, sf_dir).select("details_id", C.compact_datetime(F.col("time")).alias("compact"))


@query("compact_datetime_short")
def q_compact_datetime_short(spark, sf_dir):
    return _flat(spark, sf_dir).select("details_id", C.compact_datetime_short(F.col("time")).alias("compact"))


@query("dial_code")
def q_dial_code(spark, sf_dir):
    return _flat(spark, sf_dir).select("details_id", C.dial_code(F.col("dial_type")).alias("dial"))


@query("peer_tail")
def q_peer_tail(spark, sf_dir):
    return _flat(spark, sf_dir).select(
        "details_id", C.peer_tail(C.normalize_phone(F.col("peer_number"))).alias("tail"))


@query("fee_text")
def q_fee_text(spark, sf_dir):
    return _flat(spark, sf_dir).select("details_id", C.fee_text(F.col("fee")).alias("fee"))


@query("call_key")
def q_call_key(spark, sf_dir):
    return _flat(spark, sf_dir).select(
        "details_id", C.call_key(F.col("mobile"), F.col("time"), F.col("dial_type")).alias("base"))


@query("call_key_extended")
def q_call_key_extended(spark, sf_dir):
    f = _flat(spark, sf_dir)
    return f.select("details_id", C.call_key_extended(
        F.col("mobile"), F.col("time"), F.col("dial_type"), C.normalize_phone(F.col("peer_number")),
        F.col("details_id"), F.col("_id")).alias("base"))


@query("format_message")
def q_format_message(spark, sf_dir):
    m = fx.messages(spark, sf_dir)
    return m.select(C.format_message(F.col("offset"), F.col("key"), F.col("value")).alias("line"),
                    C.prefixed_message(F.col("value")).alias("prefixed"))


@query("message_key")
def q_message_key(spark, sf_dir):
    m = fx.messages(spark, sf_dir)
    return m.select("offset", C.message_key(F.col("timestamp")).alias("row_key"),
                    C.message_key().rlike("^[0-9]{13}$").alias("batch_key_ok"))


# ---------------------------------------------------------------------------
# JSON (J1-J4)
# ---------------------------------------------------------------------------

@query("parse_calls")
def q_parse_calls(spark, sf_dir):
    parsed = N.parse_calls(fx.call_docs(spark, sf_dir))
    return parsed.select("_id", "mobile", F.col("_valid").alias("valid"),
                         F.size("doc.calls").cast("long").alias("n_calls"))


@query("flatten_calls")
def q_flatten_calls(spark, sf_dir):
    return _flat(spark, sf_dir).select(
        F.col("_id").alias("id"), "details_id", "call_pos", "item_pos", "dial_type", "duration",
        "fee", "peer_number", "time")


@query("json_encode")
def q_json_encode(spark, sf_dir):
    e = fx.read_table(spark, sf_dir, "events")
    return e.select("event_id", N.json_encode("user_id", "event_type").alias("json"))


# ---------------------------------------------------------------------------
# Documents without a declared schema
# ---------------------------------------------------------------------------

def _open_docs(spark, sf_dir):
    return OD.parse_open(fx.open_docs(spark, sf_dir), "payload")


def _open_cells(spark, sf_dir):
    # Documents that are not valid give no cells.
    docs = _open_docs(spark, sf_dir).withColumn("rowkey", C.reverse_text(F.col("_id")))
    return OD.open_cells(docs, "rowkey")


@query("open_rejects")
def q_open_rejects(spark, sf_dir):
    return _open_docs(spark, sf_dir).where("not _valid").select("_id", "payload")


@query("open_calls")
def q_open_calls(spark, sf_dir):
    flat = OD.flatten_open_calls(fx.call_docs(spark, sf_dir), jobs.PAYLOAD)
    return flat.select(F.col("_id").alias("id"), "details_id", "call_pos", "item_pos", "dial_type", "duration",
                       "fee", "peer_number", "time")


@query("open_profile")
def q_open_profile(spark, sf_dir):
    return OD.field_profile(_open_docs(spark, sf_dir))


@query("open_cells")
def q_open_cells(spark, sf_dir):
    return CE.sort_cells(_open_cells(spark, sf_dir))


@query("open_rows")
def q_open_rows(spark, sf_dir):
    return OD.row_maps(_open_cells(spark, sf_dir)).select("rowkey", F.to_json("fields").alias("fields"))


@query("map_cells")
def q_map_cells(spark, sf_dir):
    return CE.sort_cells(OD.map_cells(OD.row_maps(_open_cells(spark, sf_dir)), "rowkey", "fields"))


# ---------------------------------------------------------------------------
# Keys (G2-G5)
# ---------------------------------------------------------------------------

@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf_dir):
    u = _first_items(spark, sf_dir)
    return u.select("base", "peer_number", "time", "id", "details_id")


@query("call_sequence")
def q_call_sequence(spark, sf_dir):
    # Read three times: for the split points, for what is carried and for the numbers.
    u = materialize(_first_items(spark, sf_dir).drop("peer_number", "time"), "first-items")
    return K.sequence_key(u, "base", list(jobs.CALL_ORDER), "rowkey", "").select("rowkey", "details_id")


@query("contact_sequence")
def q_contact_sequence(spark, sf_dir):
    c = jobs.contact_base(fx.contacts(spark, sf_dir))
    return K.sequence_key(c, "_base", ["ord"], "rowkey", "_").select("ord", "rowkey")


@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    return jobs.contacts_latest(fx.contacts(spark, sf_dir))


# ---------------------------------------------------------------------------
# Sort and reshape
# ---------------------------------------------------------------------------

@query("sort_cells")
def q_sort_cells(spark, sf_dir):
    return CE.with_order(_contact_cells(spark, sf_dir))


@query("contact_cells_plain")
def q_contact_cells_plain(spark, sf_dir):
    rows = jobs.contact_rows(fx.contacts(spark, sf_dir))
    return CE.to_cells(rows, "rowkey")


@query("contact_cells")
def q_contact_cells(spark, sf_dir):
    c = jobs.contact_base(fx.contacts(spark, sf_dir))
    keyed = K.sequence_key(c, "_base", ["ord"], "rowkey", "_")
    rows = keyed.select("rowkey", "name", "phoneNo",
                        F.coalesce(C.normalize_phone(F.col("tel")), F.lit(C.NO_TEL)).alias("tel"))
    return CE.to_cells(rows, "rowkey")


@query("contact_wide")
def q_contact_wide(spark, sf_dir):
    return jobs.contact_wide(fx.contacts(spark, sf_dir))


# ---------------------------------------------------------------------------
# Rows that cannot be keyed, and unusual ones that can
# ---------------------------------------------------------------------------

@query("call_rejects")
def q_call_rejects(spark, sf_dir):
    _, rejects = jobs.calls_to_cells(fx.faulty_call_docs(spark, sf_dir))
    return rejects


@query("call_edges")
def q_call_edges(spark, sf_dir):
    items, _ = jobs.call_items(fx.faulty_call_docs(spark, sf_dir))
    return items.select("id", "base", "fee", "peer_number", C.peer_tail(F.col("peer_number")).alias("tail"),
                        C.product_type(F.col("id")).alias("product"), "location")


@query("contact_rejects")
def q_contact_rejects(spark, sf_dir):
    return jobs.contact_rejects(fx.contacts_with_gaps(spark, sf_dir)).drop("phoneNo")


# ---------------------------------------------------------------------------
# Sinks (K1-K7)
# ---------------------------------------------------------------------------

@query("write_sorted_cells")
def q_write_sorted_cells(spark, sf_dir):
    staging = S.staging_path(scratch_path(spark, "stage"), "ns:contacts")
    S.write_sorted_cells(_contact_cells(spark, sf_dir), staging, presorted=True)
    S.check_staging(spark, staging)
    return spark.read.parquet(staging)


@query("publish_cells")
def q_publish_cells(spark, sf_dir):
    base = scratch_path(spark, "publish")
    staging = S.write_sorted_cells(_contact_cells(spark, sf_dir), S.staging_path(base, "ns:contacts"),
                                   presorted=True)
    target = f"{base}/table"
    S.publish(spark, staging, target)
    S.publish(spark, staging, target)  # a second batch of the same cells leaves the same state
    return S.read_cells(spark, target)


@query("publish_existing")
def q_publish_existing(spark, sf_dir):
    base = scratch_path(spark, "bulkload")
    staging = S.write_sorted_cells(_contact_cells(spark, sf_dir), S.staging_path(base, "ns:contacts"),
                                   presorted=True)
    target = f"{base}/table"
    S.publish_existing(spark, staging, target, move=True)  # files move into the table, as a bulk load
    return S.read_cells(spark, target)


@query("publish_order")
def q_publish_order(spark, sf_dir):
    base = scratch_path(spark, "publish-order")
    staging = S.write_sorted_cells(_contact_cells(spark, sf_dir), S.staging_path(base, "ns:contacts"), presorted=True)
    layer = S.publish(spark, staging, f"{base}/table")
    S.check_staging(spark, layer)
    spans = S.file_spans(spark, layer)
    before = Window.orderBy("lo", "file", "start")  # one row per file split
    seen = spans.withColumn("overlap", F.lag("hi").over(before) >= F.col("lo")).agg(
        F.bool_and("rising").alias("sorted"), F.count_if("overlap").alias("overlaps"))
    return seen.withColumn("cells", F.lit(spark.read.parquet(layer).count()).cast("long"))


@query("raw_published")
def q_raw_published(spark, sf_dir):
    base = scratch_path(spark, "raw-published")
    cells = jobs.raw_docs_latest(fx.raw_docs(spark, sf_dir))
    staging = S.write_sorted_cells(cells, S.staging_path(base, "ns:raw"), presorted=True)
    S.publish(spark, staging, f"{base}/table", move=True)
    return S.read_cells(spark, f"{base}/table")


@query("upsert_wide")
def q_upsert_wide(spark, sf_dir):
    rows = jobs.raw_rows(fx.raw_docs(spark, sf_dir)).withColumn("task_id", F.col("task_id").cast("long"))
    target = scratch_path(spark, "upsert")
    S.upsert(rows, target, "rowkey", "task_id")
    S.upsert(rows, target, "rowkey", "task_id")
    return S.read_rows(spark, target, "rowkey", "task_id")


@query("write_split_cells")
def q_write_split_cells(spark, sf_dir):
    # Regions by the first digit of the row key; the region is read from the number of the file.
    staging = S.staging_path(scratch_path(spark, "stage"), "ns:regions")
    S.write_sorted_cells(_contact_cells(spark, sf_dir), staging, points=REGION_POINTS)
    S.check_staging(spark, staging)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("int")
    return spark.read.parquet(staging).select(*S.CELL_KEY, "value", number.alias("region"))


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    # The newest message of every user, from a paced stream whose last batch is run twice.
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-upsert")
    m = fx.messages(spark, sf_dir)
    _write_wave(m, src)
    stream = _user_rows(M.read_messages(spark, "parquet", src, per_trigger=FILES_PER_BATCH))
    S.stream_upsert(stream, sink, "user_id", "offset", ckpt, "users").awaitTermination()
    last = S.batches(spark, sink)[-1]
    S.upsert(_user_rows(m), sink, "user_id", "offset", batch=last)  # a repeated batch changes nothing
    return S.read_rows(spark, sink, "user_id", "offset").withColumn("batches_kept", F.lit(S.batches(spark, sink)[-1] == last))


def _user_rows(messages: DataFrame) -> DataFrame:
    return M.decode_messages(messages, MESSAGE_VALUE_SCHEMA, keep=("topic", "offset")).where("user_id is not null")


# ---------------------------------------------------------------------------
# Streams (S6-S10, F6, K8-K10, J4, W7, W8)
# ---------------------------------------------------------------------------

def _write_wave(messages: DataFrame, path: str) -> None:
    # The data's own partitioning: the number of files grows with the data.
    messages.write.mode("append").parquet(path)


def _stream_setup(spark, sf_dir, name):
    base = scratch_path(spark, name)
    return base, f"{base}/source", f"{base}/sink", f"{base}/checkpoint"


def _backlog(m: DataFrame) -> DataFrame:
    return m.where(F.col("timestamp") < F.lit(STREAM_CUTOFF).cast("timestamp"))


def _later(m: DataFrame) -> DataFrame:
    return m.where(F.col("timestamp") >= F.lit(STREAM_CUTOFF).cast("timestamp"))


def _msg_cols(df: DataFrame) -> DataFrame:
    return df.select("key", "value", "topic", "offset")


@query("stream_read")
def q_stream_read(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-read")
    _write_wave(fx.messages(spark, sf_dir), src)
    M.run_available(_msg_cols(M.read_messages(spark, "parquet", src)), sink, ckpt)
    return spark.read.parquet(sink)


@query("stream_read_latest")
def q_stream_read_latest(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-latest")
    m = fx.messages(spark, sf_dir)
    _write_wave(_backlog(m), src)
    stream = _msg_cols(M.read_messages(spark, "parquet", src))
    M.prime_latest(stream, sink, ckpt)          # start at "latest": the backlog is skipped
    _write_wave(_later(m), src)
    M.run_available(stream, sink, ckpt)
    return spark.read.parquet(sink)


@query("stream_paced")
def q_stream_paced(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-paced")
    _write_wave(fx.messages(spark, sf_dir), src)
    paced = M.read_messages(spark, "parquet", src, per_trigger=FILES_PER_BATCH)
    M.run_available(_msg_cols(paced), sink, ckpt)
    files = sum(n.endswith(".parquet") for n in S._list_names(spark, src))
    batches = sum(n.isdigit() for n in S._list_names(spark, f"{ckpt}/commits"))
    return spark.read.parquet(sink).withColumn("paced", F.lit(batches == -(-files // FILES_PER_BATCH)))


@query("stream_paced_bytes")
def q_stream_paced_bytes(spark, sf_dir):
    # Files of uneven size; every batch stays within the bytes unless a single file is larger.
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-bytes")
    _write_wave(fx.messages(spark, sf_dir).repartitionByRange(8, F.sqrt("offset") * F.rand(3)), src)
    stream = M.read_messages(spark, "parquet", src, max_bytes=BYTES_PER_BATCH)
    sized = stream.select("key", "value", "topic", "offset", F.col("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_size").alias("bytes"))

    def keep(rows: DataFrame, number: int) -> None:
        rows.withColumn("number", F.lit(number)).write.mode("overwrite").parquet(f"{sink}/wave={number}")

    run = sized.writeStream.foreachBatch(keep).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    run.awaitTermination()
    got = spark.read.parquet(sink)
    # A row per file and batch.
    held = got.select("number", "file", "bytes").distinct().groupBy("number").agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
    fits = held.agg(F.bool_and((F.col("b") <= BYTES_PER_BATCH) | (F.col("n") == 1)).alias("f")).first()["f"]
    return got.select("key", "value", "topic", "offset", F.lit(bool(fits)).alias("within_bytes"))


@query("stream_resume")
def q_stream_resume(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-resume")
    m = fx.messages(spark, sf_dir)
    _write_wave(_backlog(m), src)
    stream = _msg_cols(M.read_messages(spark, "parquet", src))
    M.run_available(stream, sink, ckpt)
    _write_wave(_later(m), src)
    M.run_available(stream, sink, ckpt)         # restart: continues after the last batch
    M.run_available(stream, sink, ckpt)         # nothing new: adds nothing
    return spark.read.parquet(sink)


@query("stream_topics")
def q_stream_topics(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-topics")
    _write_wave(fx.messages(spark, sf_dir), src)
    M.run_available(_msg_cols(M.read_messages(spark, "parquet", src, topics=LISTEN_TOPICS)), sink, ckpt)
    return spark.read.parquet(sink)


@query("stream_format")
def q_stream_format(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-format")
    _write_wave(fx.messages(spark, sf_dir), src)
    M.run_available(M.format_lines(M.read_messages(spark, "parquet", src)), sink, ckpt)
    return spark.read.parquet(sink)


@query("stream_json_decode")
def q_stream_json_decode(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-decode")
    _write_wave(fx.messages(spark, sf_dir), src)
    decoded = M.decode_messages(M.read_messages(spark, "parquet", src), MESSAGE_VALUE_SCHEMA)
    M.run_available(decoded, sink, ckpt)
    return spark.read.parquet(sink)


@query("stream_write")
def q_stream_write(spark, sf_dir):
    path = scratch_path(spark, "sink-text")
    M.write_messages(fx.messages(spark, sf_dir).select("value"), "json", path)
    return spark.read.schema("value string").json(path)


@query("stream_write_json")
def q_stream_write_json(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "stream-write-json")
    e = fx.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    e.write.parquet(src)
    rows = spark.readStream.schema("event_id bigint, user_id bigint, event_type string").parquet(src)
    M.run_available(M.encode_messages(rows, ["user_id", "event_type"]), sink, ckpt, fmt="json")
    out = spark.read.schema("key string, value string").json(sink)
    return out.select("value", F.col("key").rlike(r"^[0-9]{13}$").alias("key_ok"))


@query("message_roundtrip")
def q_message_roundtrip(spark, sf_dir):
    # Sent with time keys, received from the latest position on, logged as lines.
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "roundtrip")
    sent = fx.messages(spark, sf_dir).withColumn("key", C.message_key(F.col("timestamp")))
    _write_wave(sent.where(F.lit(False)), src)  # the topic exists, without messages
    stream = M.read_messages(spark, "parquet", src)
    M.prime_latest(M.format_lines(stream), sink, ckpt)
    _write_wave(sent, src)
    M.run_available(M.format_lines(stream), sink, ckpt)
    return spark.read.parquet(sink)


@query("message_listen")
def q_message_listen(spark, sf_dir):
    _, src, sink, ckpt = _stream_setup(spark, sf_dir, "listen")
    _write_wave(fx.messages(spark, sf_dir), src)
    stream = M.read_messages(spark, "parquet", src, topics=LISTEN_TOPICS,
                             per_trigger=FILES_PER_BATCH)
    M.run_available(M.format_lines(stream), sink, ckpt)
    return spark.read.parquet(sink)


# ---------------------------------------------------------------------------
# Whole jobs
# ---------------------------------------------------------------------------

@query("calls_to_cells")
def q_calls_to_cells(spark, sf_dir):
    cells, _ = jobs.calls_to_cells(fx.call_docs(spark, sf_dir))
    return cells


@query("raw_docs_to_cells")
def q_raw_docs_to_cells(spark, sf_dir):
    return jobs.raw_docs_to_cells(fx.raw_docs(spark, sf_dir))


@query("contacts_to_cells")
def q_contacts_to_cells(spark, sf_dir):
    return _contact_cells(spark, sf_dir)


@query("contacts_to_cells_plain")
def q_contacts_to_cells_plain(spark, sf_dir):
    return jobs.contacts_to_cells_plain(fx.contacts(spark, sf_dir))


@query("contacts_wide")
def q_contacts_wide(spark, sf_dir):
    target = scratch_path(spark, "contacts-wide")
    S.upsert(jobs.contact_rows(fx.contacts(spark, sf_dir), exclude=(), raw=("ord",)), target, "rowkey", "ord")
    return S.read_rows(spark, target, "rowkey", "ord")


@query("job_accounts")
def q_job_accounts(spark, sf_dir):
    base = scratch_path(spark, "accounts")
    made = [accounts.write_calls(fx.faulty_call_docs(spark, sf_dir).unionByName(fx.call_docs(spark, sf_dir)), f"{base}/calls"),
            accounts.write_raw(fx.raw_docs(spark, sf_dir), f"{base}/raw"),
            accounts.write_contacts(fx.contacts_with_gaps(spark, sf_dir), f"{base}/contacts")]
    return made[0].unionByName(made[1]).unionByName(made[2])
