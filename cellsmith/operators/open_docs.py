"""Documents whose fields are not known when the plan is made (J1, J2, S5, R1, R4 on an open schema).

A document is parsed once into a variant value.  Fields are read from it by
path, its schema is found by an aggregate, and every top-level field becomes a
cell, so a field that occurs in a single document needs no declared column.
All of it is narrow, except the aggregate and the sort of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.operators.cells import FAMILY
from cellsmith.operators.nested import ITEM_FIELDS


def parse_open(df: DataFrame, payload: str, out: str = "doc") -> DataFrame:
    """Parse JSON text into the variant ``out`` and flag ``_valid`` documents.

    A document is valid when the text is one JSON object, with no name twice in an
    object, and nothing else; ``out`` is null otherwise.  Nothing is declared:
    ``{}`` is valid.  As in ``parse_calls``, text behind the document is found by
    parsing it as the first of two elements.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), F.col(payload), F.lit(",{}]")))
    parts = F.try_variant_get(F.col("_whole"), "$", "array<variant>")
    held = df.withColumn("_whole", pair).withColumn("_parts", parts)
    first = F.element_at("_parts", 1)
    one = (F.size("_parts") == 2) & F.startswith(F.schema_of_variant(first), F.lit("OBJECT<"))
    return (held.withColumn(out, F.when(one, first)).drop("_whole", "_parts")
            .withColumn("_valid", F.col(out).isNotNull()))


def flatten_open_calls(df: DataFrame, payload: str, keep: Sequence[str] = ("_id", "mobile")) -> DataFrame:
    """One row per item of ``calls[].items[]``, read by path (J2 without a declared schema).

    Rows and columns are those of ``flatten_calls``; a document whose calls or
    items are no lists gives none.  Numbers are as the variant holds them (``12.50``
    reads ``12.5``).
    """
    docs = parse_open(df, payload, "_doc")
    docs = docs.withColumn("_calls", F.try_variant_get("_doc", "$.calls", "array<variant>"))
    lists = F.transform("_calls", lambda c: F.try_variant_get(c, "$.items", "array<variant>"))
    # No filters before the outer explodes: pushed down, they would parse the document again.
    docs = docs.withColumn("_lists", lists)
    whole = F.when(~F.exists("_lists", lambda x: x.isNull()), F.col("_lists"))
    calls = docs.select(*keep, F.posexplode_outer(whole).alias("call_pos", "_items"))
    items = calls.select(*keep, "call_pos", F.posexplode_outer("_items").alias("item_pos", "_item"))
    return items.where(F.col("item_pos").isNotNull()).select(
        *keep, F.col("call_pos").cast("long").alias("call_pos"), F.col("item_pos").cast("long").alias("item_pos"),
        *[F.try_variant_get("_item", f"$.{f}", "string").alias(f) for f in ITEM_FIELDS])


def open_fields(df: DataFrame, doc: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """One row per top-level field of the variant object ``doc``: ``keep``, ``field`` and the variant ``value``.

    Values that are no objects (null too) give no rows; ``{}`` gives none.
    """
    spark = df.sparkSession
    # Private names, since the columns of the explode (pos, key, value) may be columns of the table too.
    held = {f"_kept{i}": c for i, c in enumerate(keep)}
    rows = df.select(F.col(doc).alias("_open"), *[F.col(c).alias(n) for n, c in held.items()])
    entries = spark.tvf.variant_explode(F.col("_open").outer())
    # An entry without a name is one of a list.  A filter before, on the value, would make it a second time.
    return rows.lateralJoin(entries).where(F.col("key").isNotNull()).select(
        *[F.col(n).alias(c) for n, c in held.items()], F.col("key").alias("field"), F.col("value"))


def field_profile(df: DataFrame, doc: str = "doc") -> DataFrame:
    """``field, kind, documents``: how many documents hold a top-level field with values of a kind.

    ``kind`` is the head of the value's type (``BIGINT``, ``DECIMAL``, ``STRING``,
    ``ARRAY``, ``OBJECT``, ``VOID`` for a JSON null).  The counts are combined before
    the shuffle, so a field that all documents have is no hot key.
    """
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z ]+", 0)
    return open_fields(df, doc).groupBy("field", kind.alias("kind")).agg(F.count(F.lit(1)).alias("documents"))


def open_schema(df: DataFrame, doc: str = "doc") -> str | None:
    """The schema all documents fit, as text, by one aggregate (S5); null without documents."""
    return df.agg(F.schema_of_variant_agg(F.col(doc)).alias("s")).first()["s"]


def open_cells(df: DataFrame, key: str, doc: str = "doc", drop: Sequence[str] = (), family: str = FAMILY) -> DataFrame:
    """One cell per top-level field of each document; the field's name is the qualifier.

    Text is kept as it is, numbers and booleans are written out, lists and objects
    are JSON text, a JSON null is ``""``.  Fields named in ``drop`` are left out.  Rows without a
    key, and values that are no objects, give no cells.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("rowkey"), F.col(doc).alias("_doc"))
    fields = open_fields(rows, "_doc", keep=("rowkey",))
    if drop:
        fields = fields.where(~F.col("field").isin(*drop))
    return fields.select(
        "rowkey", F.lit(family).alias("family"), F.col("field").alias("qualifier"),
        F.coalesce(F.try_variant_get("value", "$", "string"), F.lit("")).alias("value"))


def map_cells(df: DataFrame, key: str, entries: str, family: str = FAMILY) -> DataFrame:
    """One cell per entry of the map ``entries``; its keys are the qualifiers, a null value is ``""``.

    Rows without a key or with a null or empty map give no cells.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("rowkey"), F.explode(entries).alias("qualifier", "_v"))
    return rows.select("rowkey", F.lit(family).alias("family"), F.col("qualifier").cast("string").alias("qualifier"),
                       F.coalesce(F.col("_v").cast("string"), F.lit("")).alias("value"))


def row_maps(cells: DataFrame) -> DataFrame:
    """Cells back to one row per row key: ``rowkey`` and the map ``fields`` (R4 with open qualifiers).

    Of a repeated qualifier, the greatest value stays; it is found before the map is made, combined map-side, so
    only a row's own qualifiers meet in one task.
    """
    one = cells.groupBy("rowkey", "qualifier").agg(F.max("value").alias("value"))
    entries = F.sort_array(F.collect_list(F.struct("qualifier", "value")))
    return one.groupBy("rowkey").agg(F.map_from_entries(entries).alias("fields"))
