import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, tiny and very long texts, ties, repeats and clashing extra columns."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [
        (0, None, "en", "s", None), (1, "", None, "s", 0), (2, "one two", "en", None, 7), (3, " \t\n ", "en", "s", 4),
        (4, long_text, "de", "s", len(long_text)), (5, long_text, "de", "t", len(long_text)),
        (6, "Ünïcode ß 漢字 🙂 <|endoftext|> text", "fr", "t", 30), (7, "one two", "en", "s", 7), (7, "one two", "en", "s", 7),
        (None, "an id is missing here today", "en", "s", 27), (8, "a" * 70_000, "en", "s", 70_000),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for extra in ("size", "shard", "score", "items", "part", "tail", "cid", "label", "probability", "n_tokens", "topic"):
        df = df.selectExpr("*", f"'x' AS {extra}")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest table, on the driver and as a DataFrame."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r.doc_id: r.text for r in df.collect()}
