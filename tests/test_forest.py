import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowspark.operators import forest, models

CFG = models.TrainConfig(rf_trees=7, rf_depth=5, gbt_rounds=6, gbt_depth=3)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).select("id", *[F.round(F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(1000)) / 1000, 3).alias(f"x{i}") for i in range(4)])
    y = (F.col("x0") + F.col("x1") * F.col("x2") > 0.8).cast("double")
    return df.select("id", y.alias("y"), F.array(*[f"x{i}" for i in range(4)]).alias("x")).withColumn("features", array_to_vector("x")).cache()


def test_a_spark_forest_scores_alike_as_a_node_table(spark, rows):
    model = models.fit_forest(rows, "y", "features", CFG)
    nodes, depth = forest.from_model(model, spark)
    both = forest.class_probabilities(models.malicious_prob(model, rows), nodes, "x", depth)
    assert both.where(F.abs(F.col("prob") - F.col("probs")[1]) > 1e-9).count() == 0
    assert both.agg(F.countDistinct(F.round("prob", 6))).first()[0] > 20


def test_a_boosted_model_scores_alike_as_a_node_table(spark, rows):
    model = models.fit_boosted(rows, "y", "features", CFG)
    nodes, depth = forest.from_model(model, spark)
    both = forest.boosted_probability(models.malicious_prob(model, rows), nodes, "x", depth, "p")
    assert both.where(F.abs(F.col("prob") - F.col("p")) > 1e-9).count() == 0


def test_forest_by_rule_against_plain_loops(spark, rows):
    nodes = forest.by_rule(rows, "x", "y", 2, 4, trees=3, depth=2)
    data = [(r.id, int(r.y), r.x) for r in rows.collect()]
    mean = [round(sum(x[f] for _, _, x in data) / len(data), 6) for f in range(4)]

    def leaf(t, x):
        n, path = 0, [0]
        for _ in range(2):
            n = 2 * n + (1 if x[(t * 7 + n * 5) % 4] <= mean[(t * 7 + n * 5) % 4] else 2)
            path.append(n)
        return n, path

    counts = {}
    for _, y, x in data:
        for t in range(3):
            for n in leaf(t, x)[1]:
                counts.setdefault((t, n), [0, 0])[y] += 1
    got = {(r.tree, r.node): [int(c) for c in r.counts] for r in nodes.collect()}
    assert {k: v for k, v in got.items() if sum(v)} == counts and len(got) == 21
    leaves = {r.id: list(r.leaves) for r in forest.with_leaves(rows, nodes, "x", 2).collect()}
    assert all(leaves[i] == [leaf(t, x)[0] for t in range(3)] for i, _, x in data)
    shares = {r.id: r.probs[1] for r in forest.class_probabilities(rows, nodes, "x", 2).collect()}
    for i, _, x in data:
        want = sum(counts[t, leaf(t, x)[0]][1] / sum(counts[t, leaf(t, x)[0]]) for t in range(3)) / 3
        assert shares[i] == pytest.approx(want, abs=1e-12)
    assert forest.importances(nodes).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_scoring_stays_in_the_jvm(spark, rows):
    nodes = forest.by_rule(rows, "x", "y", 2, 4)
    plan = forest.class_probabilities(rows, nodes, "x", 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert forest.class_probabilities(rows.limit(0), nodes, "x", 3).count() == 0
