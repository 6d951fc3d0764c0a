"""JSON and nested data (J1-J4): parse, flatten, encode, decode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Item fields of the call-detail document, in the reference's (sorted) order.
ITEM_FIELDS = (
    "details_id", "dial_type", "duration", "fee", "location", "location_type", "peer_number", "time",
)

# calls[] -> items[] -> 8 text fields.  ``fee`` is an int in the source data;
# it is read as text so that both ``12`` and ``"12"`` survive, then cast.
ITEM_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ITEM_FIELDS])
CALLS_SCHEMA = T.StructType([
    T.StructField("calls", T.ArrayType(T.StructType([
        T.StructField("items", T.ArrayType(ITEM_SCHEMA)),
    ]))),
])


def parse_calls(df: DataFrame, payload: str = "moxie_carrier_originalInfo", out: str = "doc") -> DataFrame:
    """Parse the JSON payload into ``out`` and flag valid documents.

    Adds ``out`` (struct) and ``_valid`` (boolean).  A document is valid when
    the text is one JSON object and nothing else, ``calls`` is present and no
    call lacks ``items``.  ``{"calls":[]}`` is valid and yields no items later.

    The parser stops after the first JSON value, so text behind a document
    would pass unseen.  The document is therefore parsed as the first of two
    elements of an array: with anything behind it the array is malformed (null)
    or has another length.
    """
    pair = F.from_json(F.concat(F.lit("["), F.col(payload), F.lit(",{}]")), T.ArrayType(CALLS_SCHEMA))
    # A column of its own, so that the text is parsed once.
    parsed = df.withColumn("_pair", pair).withColumn(out, F.when(F.size("_pair") == 2, F.element_at("_pair", 1)))
    return parsed.drop("_pair").withColumn(
        "_valid",
        F.col(f"{out}.calls").isNotNull()
        & ~F.coalesce(F.exists(F.col(f"{out}.calls"), lambda c: c["items"].isNull()), F.lit(True)),
    )


def flatten_calls(df: DataFrame, doc: str = "doc", keep=("_id", "mobile"), valid: str | None = None,
                  payload: str | None = None, outer: bool = False) -> DataFrame:
    """One row per item of ``doc.calls[].items[]``.

    Keeps the columns in ``keep`` and adds ``call_pos`` and ``item_pos`` (the
    positions, used as a deterministic tie-break) and the eight item fields.
    Empty lists give no rows (inner explode); with ``outer`` a document or call
    without items gives one row with null positions.  Rows where the boolean
    column ``valid`` is false explode nothing; dropping them this way instead
    of by a filter keeps the optimizer from copying the JSON parse into a
    pushed-down predicate.  Narrow: no shuffle.

    With ``payload`` (a JSON text column) the documents are parsed first and
    invalid ones are skipped (``parse_calls``).
    """
    if payload is not None:
        df, doc, valid = parse_calls(df, payload, doc), doc, "_valid"
    keep = list(keep)
    # Always outer: Spark puts a test for rows before an inner explode, which makes its list, and the parse, twice.
    explode = F.posexplode_outer
    calls = F.col(f"{doc}.calls")
    if valid:
        calls = F.when(F.col(valid), calls)
    exploded = df.select(*keep, explode(calls).alias("call_pos", "_call"))
    items = exploded.select(*keep, "call_pos", explode(F.col("_call.items")).alias("item_pos", "_item"))
    if not outer:
        items = items.where(F.col("item_pos").isNotNull())
    return items.select(
        *keep,
        F.col("call_pos").cast("long").alias("call_pos"),
        F.col("item_pos").cast("long").alias("item_pos"),
        *[F.col(f"_item.{f}").alias(f) for f in ITEM_FIELDS],
    )


def json_encode(*cols) -> Column:
    """Columns to one JSON object text (J3); null fields are left out."""
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))
