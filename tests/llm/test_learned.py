"""Quality, toxicity and language: made-up texts with a known rule, edge cases, held-out accuracy on the given tables."""

import itertools
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowspark.llm import language, quality, toxicity
from flowspark.llm.labelled import bounded_sample, held_out

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
ODD = [(900, None), (901, ""), (902, "!!! 123"), (903, "word " * 60_000), (None, "plain words in a row"), (904, "same"), (904, "same")]


def made(good, bad, n=60, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        label = i % 2
        words = [rng.choice(["plain", "words", "of", "the", "river", "stone", "and"]) + rng.choice(["", "a", "b"]) for _ in range(rng.randrange(20, 60))]
        rows.append((i, (bad if label == 0 else good)(rng, words)))
        labels.append((i, label))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, label int").withColumn("text", F.lit("clash"))


def test_held_out(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
    labels = frame(spark, [(i, i % 2) for i in range(50)])
    assert bounded_sample(labels, 7).count() == 7


def test_quality(spark, make_docs):
    rows, labels = made(lambda r, w: " ".join(w) + ".", lambda r, w: " ".join(x.upper() + "!!" for x in w))
    docs = make_docs(*rows, *ODD, clash=False)
    model = quality.learn(docs.select("doc_id", "text"), frame(spark, [*labels, (None, 1), (5, None), (6, 7)]))
    scored = quality.score(docs, model, out="q").select("doc_id", "q").collect()
    assert len(scored) == len(rows) + len(ODD)
    assert all(0 <= r.q <= 1 for r in scored)
    assert np.mean([(r.q >= 0.5) == (r.doc_id % 2) for r in scored if (r.doc_id or 999) < 60]) == 1
    assert len({r.q for r in scored if r.doc_id == 904}) == 1


def test_quality_without_labels(spark, make_docs, empty_docs):
    docs = make_docs("a b")
    model = quality.learn(docs.select("doc_id", "text"), frame(spark, []))
    assert [r.score for r in quality.score(docs.drop("score"), model).collect()] == [0.5]
    assert quality.score(empty_docs, model).count() == 0


def test_discriminant_is_the_density_difference():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (200, 3)), rng.normal(1, 2, (300, 3))])
    y = np.r_[np.zeros(200, int), np.ones(300, int)]
    model = quality.fit(x, y, shrink=0, ridge=0)

    def log_density(g, z):
        c = np.cov(g, rowvar=False, bias=True)
        d = z - g.mean(0)
        return np.log(len(g) / 500) - 0.5 * (np.log(np.linalg.det(c)) + np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))

    weight = [max(0, min(1.0, 15 / len(g))) for g in (x[y == 0], x[y == 1])]
    assert max(weight) < 0.1  # the small-class rule still leans a little on the pooled covariance
    want = log_density(x[y == 1], x) - log_density(x[y == 0], x)
    assert np.corrcoef(model.difference(x), want)[0, 1] > 0.999


def test_toxicity(spark, make_docs):
    rows, labels = made(lambda r, w: " ".join([*w, r.choice(["Vile!", "vile", "rotten"]), "vileness"]), lambda r, w: " ".join(w), n=80)
    docs = make_docs(*rows, *ODD)
    chain = toxicity.learn(docs, frame(spark, [*labels, (None, 1), (3, None)]))
    judged = toxicity.with_toxicity(docs, chain).select("doc_id", "_toxicity.*").collect()
    assert all(0 <= p <= 1 for r in judged for p in (r.insult, r.dense, r.toxic))
    assert all(r.rejected == (r.doc_id % 2 == 1) for r in judged if r.doc_id is not None and r.doc_id < 80)
    assert not any(r.rejected for r in judged if r.doc_id is None or r.doc_id >= 900)
    left = toxicity.drop_toxic(docs, chain)
    assert left.columns == docs.columns and left.count() == 40 + len(ODD)


def test_toxicity_without_labels(spark, make_docs, empty_docs):
    chain = toxicity.learn(make_docs("a b"), frame(spark, []))
    assert [r.rejected for r in toxicity.with_toxicity(make_docs("a"), chain).select("_toxicity.*").collect()] == [False]
    assert toxicity.drop_toxic(empty_docs, chain).count() == 0


def test_later_models_see_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    first = (rng.random(400) < 0.5).astype(float)  # noise: in-sample fits would look better than they are
    chain = toxicity.fit_chain(toxicity.Chain(np.empty(0, np.uint64), ["a", "b"]), x, np.stack([first, first], 1), np.arange(400) % 4)
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert chain.weights[1][-2] < 1


def test_language(spark, make_docs, empty_docs):
    rng = random.Random(2)
    parts = {"xx": ["foo", "bar", "baz", "qua"], "yy": ["tri", "tzel", "öst", "mung"]}

    def said(lang, n):
        return " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(n))

    rows = [(i, said("xx" if i % 2 else "yy", rng.randrange(5, 80))) for i in range(120)]
    docs = make_docs(*rows, *ODD, clash=False).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "xx").when(F.col("doc_id") < 120, "yy"))
    model = language.learn(docs)
    assert model.languages == ["xx", "yy"]
    got = language.with_language(docs, model).select("doc_id", "_language.*").collect()
    assert all((r.lang_pred == "xx") == (r.doc_id % 2 == 1) and 0.5 <= r.score <= 1 for r in got if (r.doc_id or 999) < 120)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (900, 901, 902)} == {("und", 0.0)}
    mixed = model.shares(pa.array([said("xx", 40) + " " + said("yy", 40)]))[0]
    assert 0.3 < mixed[0] < 0.7
    none = language.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.with_language(docs, none).select("_language.*").collect()} == {"und"}
    assert language.with_language(empty_docs, model).count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    model = language.Tagger(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)))
    scores = rng.normal(size=(7, 3))
    post, total, moved = model.marginals(scores, np.array([0, 4]), np.array([4, 3]))
    want, pairs = 0.0, np.zeros((3, 3))
    for a, b in ((0, 4), (4, 7)):
        z, p, q = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=b - a):
            w = np.exp(sum(scores[a + k, c] for k, c in enumerate(y)) + sum(model.moves[y[k - 1], y[k]] for k in range(1, b - a)))
            z += w
            for k, c in enumerate(y):
                p[k, c] += w
                if k:
                    q[y[k - 1], c] += w
        assert np.allclose(p / z, post[a:b])
        want, pairs = want + np.log(z), pairs + q / z
    assert np.isclose(want, total) and np.allclose(pairs, moved)


@tables
def test_held_out_accuracy(spark):
    from flowspark.llm.queries import QUERIES

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    q = QUERIES["op2_quality"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    low, high = [r.score for r in q if r.quality == 0], [r.score for r in q if r.quality == 1]
    assert np.mean([a < b for a in low for b in high]) > 0.95
    t = QUERIES["op3_toxicity"](spark, SF).drop("toxic").join(labels, "doc_id").collect()
    assert np.mean([r.rejected == bool(r.toxic) for r in t]) > 0.93
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    g = QUERIES["op6_language"](spark, SF).join(documents, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in g]) > 0.97
