"""Corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last keep the columns of ``documents`` and drop rows.  ``run`` writes each
stage as Parquet in the shared folder and reads it back for the next.

Rows are matched by ``doc_id``.  Each row is judged by its own text, except
that rows of one id stand or fall together in the near-duplicate
stage.  An empty table passes through all stages.  Further columns pass
through unchanged whatever their names; the stages' own columns get names
that no column has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith.llm import chosen_path, decontam, raking, ring, toxicity
from cellsmith.llm.common import private, read
from cellsmith.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1 (toxicity): documents predicted toxic go."""
    names = private(docs.columns, *toxicity.NAMES)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), names=names)
    return scored.where(F.col(names[0]) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2 (MinHash near-dedup): one document of each group stays."""
    (gone,) = private(docs.columns, "gone")
    found = chosen_path.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(gone))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3 (benchmark decontamination): documents with a benchmark passage go."""
    names = private(docs.columns, *decontam.NAMES)
    found = decontam.find(docs, read(spark, sf_dir, "benchmark"), keep=tuple(docs.columns), names=names)
    return found.where(~F.col(names[2])).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4 (mixing to target weights): documents are sampled by calibrated probabilities.

    The topic is that of the text; a column ``topic`` of the documents is left as it is."""
    topic, tokens, *names = private(docs.columns, "topic", "n_tokens", *raking.NAMES)
    mixed = raking.mix(raking.with_topic(docs, names=(topic, tokens)), ("source", "lang", topic), names=tuple(names), n_tokens=tokens)
    return mixed.where(F.col(names[2])).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5 (sharding): the manifest of eight shards."""
    return ring.manifest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The trained classifier and the randomised join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
