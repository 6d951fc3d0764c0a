"""The pipeline against its stages in plain Python, its oracle queries, and odd tables."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from cellsmith.llm import chosen_path, decontam, queries, raking, ring, toxicity
from cellsmith.llm.common import read

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names


def _norm(v):
    return "\0" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    got = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    order = sorted(got.columns)
    a = sorted(tuple(_norm(r[c]) for c in order) for r in got.collect())
    b = sorted(tuple(_norm(v) for v in r) for r in rel.project(", ".join(f'"{c}"' for c in order)).fetchall())
    assert a == b


def test_pipeline_stage_by_stage(spark):
    docs = read(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, read(spark, SF, "labels")).collect() if r.predicted}
    left = {i: t for i, t in text.items() if i not in toxic}
    frame = lambda: docs.where(docs.doc_id.isin(list(left)))
    near = {r.doc_id for r in chosen_path.near_duplicates(frame()).collect() if not r.kept}
    left = {i: t for i, t in left.items() if i not in near}
    items = [decontam.normal(r.text) for r in read(spark, SF, "benchmark").collect()]
    left = {i: t for i, t in left.items() if not any(x in decontam.normal(t) for x in items)}
    drawn = {r.doc_id for r in raking.mix(raking.with_topic(frame())).collect() if r.sampled}
    left = {i: t for i, t in left.items() if i in drawn}
    want = {r.doc_id: (r.shard, r.slot) for r in ring.manifest(frame()).collect()}
    got = {r.doc_id: (r.shard, r.slot) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and set(got) == set(left)


def test_stages_keep_columns_and_odd_rows(spark, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    clash = odd_docs.selectExpr("*", "'x' AS weight", "'x' AS sampled", "'x' AS _score", "'x' AS _items", "'x' AS _gone", "'x' AS _topic")
    for start in (plain, clash, no_docs):
        now = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == start.columns
        rows = now.collect()
        assert all(r[c] == "x" for r in rows for c in start.columns[5:])
        corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()


def test_operators_do_not_swallow_import_errors():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    files = [os.path.join(root, "corpus_pipeline.py")]
    files += [os.path.join(root, "cellsmith/llm", f) for f in os.listdir(os.path.join(root, "cellsmith/llm")) if f.endswith(".py")]
    for f in files:
        assert not re.search(r"except (Import|ModuleNotFound)", open(f).read())
