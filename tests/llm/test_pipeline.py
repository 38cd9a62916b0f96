"""Queries against their SQL, and the pipeline's stages against plain rules, on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from flowspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    names = sorted(d[0] for d in want.description)
    assert sorted(df.columns) == names
    order = [[d[0] for d in want.description].index(n) for n in names]
    assert sorted(repr(tuple(r)) for r in df.select(names).collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]

    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in clean.collect()}
    assert sum(labels.get(d) == 0 for d in texts if d not in left) <= 1

    first: dict = {}
    for d in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[d] or ""), d)
    assert {r.doc_id for r in stages["exact_dedup"](spark, docs, SF).collect()} == set(first.values())

    joined = {r.doc_id: r.component_id for r in QUERIES["op7_ngram_join"](spark, SF).collect()}
    assert {r.doc_id for r in stages["ngram_join"](spark, docs, SF).collect()} == {d for d, c in joined.items() if d == c}

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    norm = lambda t: " ".join((t or "").lower().split())
    assert left == {d for d, t in texts.items() if not any(norm(i) in norm(t) for i in items)}


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(packed.columns)
    assert 0 < packed.select("doc_id").distinct().count() < 200


def test_empty(spark, empty_docs):
    docs = empty_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
