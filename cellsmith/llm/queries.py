"""Registered queries of the operators, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellsmith.llm import (
    attention, bpe, chosen_path, decontam, licenses, perspectives, raking, resample, ring, runs,
    syncmers, token_counts, toxicity,
)
from cellsmith.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


def op4_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.manifest(read(spark, sf_dir, "documents"))


def op5_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score_texts(read(spark, sf_dir, "documents"))


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.digest(read(spark, sf_dir, "conversations"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op10_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = raking.mix(raking.with_topic(read(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "weight", "sampled")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    ops = (op1_license_scan, op2_toxicity, op3_syncmers, op4_ring, op5_attention, op6_perspectives,
           op7_decontamination, op8_chosen_path, op9_token_counts, op10_raking, op11_byte_bpe, op12_resample, op13_word_runs)
    return {f.__name__: f for f in ops} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.ORACLE, "op6_perspectives": perspectives.ORACLE, "op10_raking": _raking_sql(),
            "op12_resample": resample.ORACLE}


def _raking_sql(temper: float = raking.TEMPER, sweeps: int = 30) -> str:
    """Raking as one step per margin and sweep over the cell table.

    SQL cannot stop on the residual; after 30 sweeps it is below 1e-13 on the given tables."""
    steps, last = [], "c0"
    goals = ", ".join(f"g_{d} AS (SELECT {d}, p / sum(p) OVER () * t AS goal FROM (SELECT {d}, "
                      f"CASE WHEN s > 0 THEN pow(s / t, {temper}) ELSE 0 END AS p, t FROM (SELECT {d}, sum(tokens)::DOUBLE AS s, "
                      f"(SELECT greatest(sum(tokens), 1)::DOUBLE FROM cells) AS t FROM cells GROUP BY {d})))" for d in raking.DIMS)
    for i in range(sweeps):
        for d in raking.DIMS:
            name = f"c{i + 1}_{d}"
            steps.append(f"{name} AS MATERIALIZED (SELECT x.source, x.lang, x.topic, tokens, CASE WHEN sum(w) OVER (PARTITION BY x.{d}) > 0 "
                         f"THEN w * goal / sum(w) OVER (PARTITION BY x.{d}) ELSE 0 END AS w "
                         f"FROM {last} x JOIN g_{d} g ON x.{d} IS NOT DISTINCT FROM g.{d})")
            last = name
    return f"""
WITH d AS (SELECT doc_id, source, lang,
  CASE WHEN contains(t, ' | ') THEN 'table' WHEN regexp_matches(t, '\\*\\*\\*|&&&|###|%%%') THEN 'symbols'
       WHEN t = upper(t) AND t <> lower(t) THEN 'capitals' ELSE 'prose' END AS topic,
  len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cells AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
{goals},
c0 AS (SELECT *, tokens::DOUBLE AS w FROM cells),
{", ".join(steps)},
r AS (SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN w / tokens ELSE 1 END AS ratio FROM {last}),
k AS (SELECT *, coalesce(sum(tokens) OVER (ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_tokens,
  sum(tokens * ratio) OVER (ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM r),
s AS (SELECT max(({raking.KEEP} * (SELECT sum(tokens) FROM r) - full_tokens) / rest) AS scale FROM k
  WHERE rest > 0 AND ({raking.KEEP} * (SELECT sum(tokens) FROM r) - full_tokens) / rest * ratio <= 1),
p AS (SELECT source, lang, topic, ratio, round(least(1, ratio * scale), 6) AS probability FROM r, s)
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, probability, CASE WHEN probability > 0 THEN round(ratio / probability, 4) ELSE 0 END AS weight,
  ('0x' || substr(md5('{raking.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0 < probability AS sampled
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic
"""
