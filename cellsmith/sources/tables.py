"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsmith.functions import columns as C

# Fixed value: rows shown by the collection preview.
PREVIEW_ROWS = 1000


def scan_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet scan (S1); selecting ``columns`` prunes the read schema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    """Catalog table or view scan."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def register_table(df: DataFrame, name: str) -> None:
    """Make a DataFrame readable by name for ``scan_table`` (session catalog)."""
    df.createOrReplaceTempView(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save ``df`` as a catalog table dealt into ``buckets`` by ``key`` and sorted by it (G1).

    Grouping or joining the table by ``key`` later needs no exchange.  The rows are dealt once
    here, so each bucket is one file.  An existing table of the name is replaced."""
    out = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite")
    (out.option("path", path) if path else out).saveAsTable(name)


# The column that holds a line no document could be read from.
MALFORMED = "_malformed"


def scan_documents_checked(spark: SparkSession, schema: str, path: str, options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` of JSON lines (S3).

    A line that is no JSON object, or whose fields do not fit the schema, is one row ``line, reason`` of the
    rejects, never a document of nulls.  Blank lines are neither; text behind an object is not
    looked at, as in Spark's own reader.  Each reads the lines when used."""
    kind = T._parse_datatype_string(f"{schema}, {MALFORMED} string")
    how = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.withColumn("_doc", F.from_json("value", kind, how))
    bad = F.col("_doc").isNull() | F.col(f"_doc.{MALFORMED}").isNotNull()
    good = rows.where(~bad).select(*[F.col("_doc")[f.name].alias(f.name) for f in kind.fields if f.name != MALFORMED])
    return good, rows.where(bad).select(F.col("value").alias("line"), F.lit("malformed").alias("reason"))


def scan_documents(
    spark: SparkSession, schema: T.StructType | str, path: str | None = None,
    fmt: str | None = None, options: dict | None = None,
) -> DataFrame:
    """Document-collection scan with a declared schema (S3).

    ``fmt``/``options`` select an external connector when its jar is on the
    classpath (for example a document-store format with database and
    collection options); by default JSON lines at ``path`` are read.
    """
    reader = spark.read.schema(schema).options(**(options or {}))
    if fmt:
        reader = reader.format(fmt)
        return reader.load(path) if path else reader.load()
    return reader.json(path)


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows (S4, O3); the limit is the feature."""
    return df.limit(n)


def preview_count(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """One row: ``rows`` (whole count) and ``preview_rows`` (rows of the preview itself)."""
    whole = df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(0).cast("long").alias("preview_rows"))
    shown = preview(df, n).agg(F.count(F.lit(1)).alias("preview_rows")).select(F.lit(0).cast("long").alias("rows"), "preview_rows")
    return whole.unionByName(shown).agg(F.sum("rows").alias("rows"), F.sum("preview_rows").alias("preview_rows"))


def generate_numbers(df: DataFrame, id_col: str) -> DataFrame:
    """Sample phone-number messages ``1860123458`` + id, one per input row."""
    return df.select(F.col(id_col).cast("long").alias("i"), C.sample_number(F.col(id_col)).alias("value"))


def generate_text(df: DataFrame, id_col: str) -> DataFrame:
    """Sample text messages ``hello ... message <id>``, one per input row."""
    return df.select(F.col(id_col).cast("long").alias("i"), C.sample_text(F.col(id_col)).alias("value"))
