"""Whole jobs (W1-W5) as lazy DataFrame plans.

Each job returns ``(cells, rejects)`` or a wide DataFrame; nothing here runs
an action except the sample for split points, the check of key prefixes, the numbering of keys that fill a
range, and the flattened call items, written once.  Rows that cannot be keyed are never lost: ``calls_to_cells``
returns them, ``contact_rejects`` gives those of the contact jobs.
Sinks (``cellsmith.sinks``) write the results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsmith.functions import columns as C
from cellsmith.operators.cells import as_text, sorted_cells, to_cells
from cellsmith.operators.keys import latest_per_key, sequence_key, unique_sequence_key
from cellsmith.operators.nested import flatten_calls, parse_calls
from cellsmith.operators.ranges import ordered_keys, partitions_for
from cellsmith.session import materialize

PAYLOAD = "moxie_carrier_originalInfo"
# Fixed value: call-detail output fields, in the reference's order.
CALL_FIELDS = ("dial_type", "duration", "fee", "id", "location", "location_type", "mobile", "peer_number", "time")
# Fixed value: raw-document output fields, in the reference's order.
RAW_FIELDS = ("_id", "create_time", "mobile", PAYLOAD, "successFlag", "task_id", "update_time")
# Fixed value: shortest create_time text that is kept.
RAW_MIN_TIME_LENGTH = 23
CALL_ORDER = ("id", "call_pos", "item_pos")
# Documents that give split points; they balance partitions and decide no result.
POINTS_SHARE = 0.1
# What decides between two raw documents of one mobile and second: the greatest.
RAW_RECENCY = ("update_time", "create_time", "_id")


def with_payload(docs: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """Documents that have a payload (F1); the filter reaches the scan."""
    return docs.where(F.col(payload).isNotNull())


def keyed_calls(docs: DataFrame, payload: str = PAYLOAD) -> DataFrame:
    """Filter, parse, flatten and key call items (F1, J1, J2, P1, P5, P6, P13, P14) in one pass.

    One row per item with ``base`` (the call key prefix), the tie-break ``id,
    call_pos, item_pos``, the item fields and ``reason``, null for good items.
    What the reference would fail on has a reason: ``payload`` (malformed text,
    text behind the document, missing lists) and ``id_or_mobile`` once per
    document; ``peer_number``, ``time`` and ``fee`` (not an integer) per item.
    """
    parsed = parse_calls(with_payload(docs, payload).select("_id", "mobile", payload), payload)
    whole = F.col("_id").isNotNull() & F.col("mobile").isNotNull()
    parsed = parsed.withColumn("_ok", F.col("_valid") & whole)
    flat = flatten_calls(parsed, "doc", keep=("_id", "mobile", "_valid"), valid="_ok", outer=True)
    keyed = flat.select(
        C.call_key(F.col("mobile"), F.col("time"), F.col("dial_type")).alias("base"),
        F.col("_id").cast("string").alias("id"), "call_pos", "item_pos", "details_id",
        "dial_type", "duration", C.fee_text(F.col("fee")).alias("fee"), "location", "location_type",
        F.col("mobile").cast("string").alias("mobile"),
        C.normalize_phone(F.col("peer_number")).alias("peer_number"), "time", "_valid",
    )
    reason = (
        F.when(~F.col("_valid"), "payload")
        .when(F.col("id").isNull() | F.col("mobile").isNull(), "id_or_mobile")
        .when(F.col("peer_number").isNull(), "peer_number")
        .when(F.col("base").isNull(), "time")
        .when(F.col("fee").isNull(), "fee"))
    in_doc = F.col("item_pos").isNotNull() | ~F.col("_valid") | F.col("id").isNull() | F.col("mobile").isNull()
    # Good documents and calls without items leave no row.
    return keyed.where(in_doc).withColumn("reason", reason).drop("_valid")


def split_calls(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(items, rejects)`` of ``keyed_calls``."""
    rejects = keyed.where(F.col("reason").isNotNull()).select("id", "mobile", "call_pos", "item_pos", "reason")
    return keyed.where(F.col("reason").isNull()).drop("reason"), rejects


def call_items(docs: DataFrame, payload: str = PAYLOAD) -> tuple[DataFrame, DataFrame]:
    """``(items, rejects)``: call items with their key prefix, and what cannot be keyed."""
    return split_calls(keyed_calls(docs, payload))


def calls_to_cells(docs: DataFrame, payload: str = PAYLOAD, strict: bool = False, once: bool = True,
                   parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Call documents -> unique, sorted cells, and rejects.

    Keep-first on ``(base, peer_number, time)`` (G2), ordinal appended to the
    key without separator (G3), every field but the key as a cell (R1b),
    total order (O1), all in one exchange (``ordered_keys``).  ``strict=True`` fails, like the original job, when any
    row would be rejected (one bounded probe: ``limit(1)``).

    The flattened items are written once to the shared folder, so the documents
    are read and parsed once for cells, rejects and the split points.  ``once=False`` leaves that out: it
    parses for each use, and a share of the documents for the split points.  Should a mobile hold a
    ``_``, keys may not follow their bases in order, and the finished keys are range-sorted.
    """
    keyed = keyed_calls(docs, payload)
    if once:
        keyed = materialize(keyed, "call-items")
    rejects = split_calls(keyed)[1]
    _check_strict(rejects, strict)
    if once:
        return cells_of_calls(keyed, parts=parts), rejects
    some = split_calls(keyed_calls(docs.sample(POINTS_SHARE, 5), payload))[0]
    return cells_of_calls(keyed, some, docs.where(F.col("mobile").isNotNull()), parts), rejects


def cells_of_calls(keyed: DataFrame, sample: DataFrame | None = None, mobiles: DataFrame | None = None,
                   parts: int | None = None) -> DataFrame:
    """The cells of ``keyed_calls``.

    ``sample`` (items) gives the split points, ``mobiles`` the mobiles whose text is checked; both are the items by default."""
    items = split_calls(keyed)[0]
    group, order = ["peer_number", "time"], list(CALL_ORDER)
    # A base is ``reverse(mobile)_<14 digits>_<digit>_``: without ``_`` in a mobile, none is a prefix of another.
    free, n = _prefix_free(items if mobiles is None else mobiles, F.col("mobile"), 0)
    if mobiles is None:
        parts = parts or partitions_for(items, n)
    if free:
        numbered = ordered_keys(items, "base", order, group, "", parts=parts, sample=items if sample is None else sample)
        return to_cells(as_text(numbered, ["rowkey", *CALL_FIELDS]), "rowkey", list(CALL_FIELDS))
    numbered = unique_sequence_key(items, "base", group, order, out="rowkey", sep="", parts=parts)
    return sorted_cells(as_text(numbered, ["rowkey", *CALL_FIELDS]), "rowkey", list(CALL_FIELDS), keys_unique=True)


def _prefix_free(df: DataFrame, text, marks: int) -> tuple[bool, int]:
    """Whether ``text`` holds ``_`` exactly ``marks`` times in every row, and the number of rows (a pruned scan)."""
    held = F.length(text) - F.length(F.replace(text, F.lit("_"), F.lit("")))
    same, n = df.agg(F.bool_and(held == marks), F.count(F.lit(1))).first()
    return same is not False, n


def raw_rows(docs: DataFrame, zone: str = C.DEFAULT_ZONE, pad: int | None = None) -> DataFrame:
    """W2 before the reshape: length filter (F2), recency key (P8, P12),
    every field as text (P2, P15).

    ``create_time`` is expected as text.  A timestamp column is first
    rendered as ``yyyy-MM-dd HH:mm:ss.SSS`` text (wall clock of the value;
    for a zoned timestamp, in the session zone)."""
    if isinstance(docs.schema["create_time"].dataType, (T.TimestampType, T.TimestampNTZType)):
        docs = docs.withColumn("create_time", F.date_format(F.col("create_time"), C.LONG_TIME_FORMAT))
    kept = docs.where(C.min_length(F.col("create_time"), RAW_MIN_TIME_LENGTH))
    key = C.recency_key(F.col("mobile"), C.text_or_empty(F.col("create_time")), zone, pad)
    return kept.select(key.alias("rowkey"), *[
        C.text_or_empty(F.col(c), kept.schema[c].dataType).alias(c) for c in RAW_FIELDS])


def raw_docs_to_cells(docs: DataFrame, zone: str = C.DEFAULT_ZONE, pad: int | None = None) -> DataFrame:
    """Raw carrier documents -> cells keyed by mobile and recency."""
    return sorted_cells(raw_rows(docs, zone, pad), "rowkey", list(RAW_FIELDS))


def raw_docs_latest(docs: DataFrame, zone: str = C.DEFAULT_ZONE, pad: int | None = None) -> DataFrame:
    """W2 as published: sorted unique cells, where documents of one key are
    resolved as whole rows (G5 by ``RAW_RECENCY``) before the reshape."""
    rows = latest_per_key(raw_rows(docs, zone, pad), "rowkey", RAW_RECENCY)
    return sorted_cells(rows, "rowkey", list(RAW_FIELDS), keys_unique=True)


def contact_base(df: DataFrame, phone: str = "phoneNo", tel: str = "tel") -> DataFrame:
    """Contacts with their key ``_base``; rows without a phone number (which
    the original jobs fail on) are left out, see ``contact_rejects``."""
    return df.where(F.col(phone).isNotNull()).withColumn("_base", C.contact_key(F.col(phone), F.col(tel)))


def contact_rejects(df: DataFrame, phone: str = "phoneNo") -> DataFrame:
    """Contacts that cannot be keyed (null phone number), with a reason."""
    return df.where(F.col(phone).isNull()).withColumn("reason", F.lit("phone"))


def _check_strict(rejects: DataFrame, strict: bool) -> None:
    if strict:
        bad = rejects.limit(1).collect()
        if bad:
            raise ValueError(f"rows that cannot be keyed, first: {bad[0].asDict()}")


def contacts_to_cells(
    df: DataFrame, order_by: Sequence[str] = ("ord",), exclude: Sequence[str] = ("ord",),
    strict: bool = False, null_tel_cell: str = C.NO_TEL, with_rejects: bool = False, parts: int | None = None
):
    """Contacts -> cells with unique keys ``reverse(phone)_tel_n``.

    A null tel is written as ``null_tel_cell`` in the cell (``noTel`` in this
    job).  Rows without a phone number are left out (``contact_rejects``);
    ``strict=True`` fails on them instead, like the original job.
    ``with_rejects=True`` returns ``(cells, rejects)`` like ``calls_to_cells``.
    One exchange for key and order, unless a phone number or tel holds a ``_``.
    """
    _check_strict(contact_rejects(df), strict)
    cols = [c for c in df.columns if c not in exclude]
    based = contact_base(df)
    # ``reverse(phone)_tel`` with no other ``_`` followed by one is no prefix of another base.
    one, n = _prefix_free(based, F.col("_base"), 1)
    parts = parts or partitions_for(based, n)
    key = ordered_keys if one else sequence_key
    keyed = key(based, "_base", list(order_by), out="rowkey", sep="_", parts=parts)
    wide = keyed.select("rowkey", *[
        (F.coalesce(C.normalize_phone(F.col("tel")), F.lit(null_tel_cell)) if c == "tel"
         else C.text_or_empty(F.col(c), keyed.schema[c].dataType)).alias(c) for c in cols])
    cells = to_cells(wide, "rowkey", cols) if one else sorted_cells(wide, "rowkey", cols, keys_unique=True, partitions=parts)
    return (cells, contact_rejects(df)) if with_rejects else cells


def contact_rows(df: DataFrame, exclude: Sequence[str] = ("ord",), raw: Sequence[str] = (),
                 null_tel_cell: str = "") -> DataFrame:
    """Contacts keyed as they are (no ordinal), tel normalised with null as
    ``null_tel_cell`` (``""`` in these jobs), other columns as text (R2/R4
    rows).  Columns in ``raw`` (for example a recency column) pass through
    with their type."""

    def value(c: str):
        if c in raw:
            return F.col(c)
        if c == "tel":
            return F.coalesce(C.normalize_phone(F.col("tel")), F.lit(null_tel_cell))
        return C.text_or_empty(F.col(c), df.schema[c].dataType)

    cols = [c for c in df.columns if c not in exclude]
    return contact_base(df).select(F.col("_base").alias("rowkey"), *[value(c).alias(c) for c in cols])


def contacts_to_cells_plain(df: DataFrame, exclude: Sequence[str] = ("ord",)) -> DataFrame:
    """Contacts -> cells, keys as they are (repeats stay), sorted."""
    rows = contact_rows(df, exclude)
    return sorted_cells(rows, "rowkey", [c for c in rows.columns if c != "rowkey"])


def contacts_to_cells_latest(df: DataFrame, order_by: Sequence[str] = ("ord",),
                             exclude: Sequence[str] = ("ord",)) -> DataFrame:
    """W4 as published: sorted unique cells, the last whole row by ``order_by`` of each key."""
    rows = latest_per_key(contact_rows(df, exclude=(), raw=tuple(order_by)), "rowkey", list(order_by))
    cols = [c for c in df.columns if c not in exclude]
    return sorted_cells(as_text(rows, ["rowkey", *cols]), "rowkey", cols, keys_unique=True)


def contact_wide(df: DataFrame, exclude: Sequence[str] = ("ord",)) -> DataFrame:
    """One wide keyed row per contact, every column in input order."""
    return contact_rows(df, exclude)


def contacts_latest(df: DataFrame, recency: str = "ord") -> DataFrame:
    """W5 state: the newest row per contact key (the overwrite of repeated keys)."""
    return latest_per_key(contact_rows(df, exclude=(), raw=(recency,)), "rowkey", recency)
