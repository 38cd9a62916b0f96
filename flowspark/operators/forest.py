"""Tree ensembles as node tables, scored in the JVM.

A node table holds one row per node: trees are numbered, nodes of a tree run from 0 (its root) without gaps, and a leaf has
no feature. Any ensemble of the library can be written as one, kept, compared and scored by array descent: the packed
table (one row, as large as the ensemble) goes to all tasks, and each row walks all trees inside one expression, so
scoring needs no Python and works on streams as well.

`by_rule` makes a forest without search: complete trees whose features follow from tree and node, with splits at the
features' means. Its leaves are counted over the table, so SQL can build and score the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import materialize, scratch_path

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, split double, left_node int, right_node int, counts array<double>, weight double"


def by_rule(df: DataFrame, features: str, label: str, classes: int, width: int, trees: int = 8, depth: int = 3, steps: tuple[int, int] = (7, 5)) -> DataFrame:
    """Node table over df: node n of tree t splits on feature (t * steps[0] + n * steps[1]) modulo width, at its mean to six places.

    Nodes are numbered level by level (children of n: 2n + 1 and 2n + 2). counts: rows of df of each class 0 .. classes - 1 that pass a
    node; weight: 1 for every tree.
    """
    spark, inner = df.sparkSession, 2**depth - 1
    means = df.select(F.posexplode(features).alias("feature", "x")).groupBy("feature").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("split"))
    shape = spark.range(trees).select(F.col("id").cast("int").alias("tree"), F.explode(F.sequence(F.lit(0), F.lit(2 ** (depth + 1) - 2))).alias("node"))
    picked = F.pmod(F.col("tree") * steps[0] + F.col("node") * steps[1], F.lit(width)).cast("int")
    shape = shape.withColumn("feature", F.when(F.col("node") < inner, picked).otherwise(-1))
    child = lambda k: F.when(F.col("feature") >= 0, 2 * F.col("node") + k).otherwise(-1).cast("int")
    bare = shape.join(F.broadcast(means), "feature", "left").select(  # a mean for each feature: as many rows as features
        "tree", "node", "feature", F.coalesce("split", F.lit(0.0)).alias("split"), child(1).alias("left_node"), child(2).alias("right_node"),
        F.array().cast("array<double>").alias("counts"), F.lit(1.0).alias("weight"))
    bare = materialize(bare, "nodes")
    passed = with_leaves(df.select(features, F.col(label).cast("int").alias("_y")), bare, features, depth).select("_y", F.posexplode("leaves").alias("tree", "leaf"))
    leaves = passed.groupBy("tree", "leaf", "_y").agg(F.count(F.lit(1)).alias("n"))
    # A leaf's rows pass all nodes above it.
    above = F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: (F.floor((F.col("leaf") + 1) / F.pow(F.lit(2), k)) - 1).cast("int"))
    counts = leaves.select("tree", F.explode(above).alias("node"), "_y", "n").groupBy("tree", "node").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("_y") == c, F.col("n"))), F.lit(0)).cast("double") for c in range(classes)]).alias("c"))
    none = F.array(*[F.lit(0.0)] * classes)
    return materialize(bare.drop("counts").join(counts, ["tree", "node"], "left").withColumn("counts", F.coalesce("c", none))
                       .select(*[c.split()[0] for c in NODES.split(", ")]), "nodes")


def from_model(model, spark: SparkSession) -> tuple[DataFrame, int]:
    """Node table and depth of a fitted Spark ML forest or boosted model. counts: class weights of a forest's node, or the
    prediction of a boosted tree's node alone."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    boosted = hasattr(model, "treeWeights") and type(model).__name__.startswith("GBT")
    d = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    leaf = F.col("leftChild") < 0
    nodes = d.select(
        F.col("treeID").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
        F.when(leaf, -1).otherwise(F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(leaf, 0.0).otherwise(F.element_at("split.leftCategoriesOrThreshold", 1)).alias("split"),
        F.col("leftChild").cast("int").alias("left_node"), F.col("rightChild").cast("int").alias("right_node"),
        (F.array("prediction") if boosted else F.col("impurityStats")).alias("counts"),
        F.get(weights, F.col("treeID")).alias("weight"))
    return materialize(nodes, "nodes"), max(t.depth for t in model.trees)


def _packed(nodes: DataFrame) -> DataFrame:
    """The ensemble as one row: nodes in order, where each tree begins."""
    rows = F.array_sort(F.collect_list(F.struct("tree", "node", "feature", "split", "left_node", "right_node", "counts", "weight")))
    packed = nodes.agg(rows.alias("_n"))
    roots = F.filter(F.sequence(F.lit(0), F.size("_n") - 1), lambda i: F.get(F.col("_n"), i).node == 0)
    parts = [F.transform("_n", lambda x: x[c]).alias(f"_{c}") for c in ("feature", "split", "left_node", "right_node", "counts", "weight")]
    return packed.select(roots.alias("_roots"), *parts)


_PACKED = ["_roots", "_feature", "_split", "_left_node", "_right_node", "_counts", "_weight"]


def _places(df: DataFrame, nodes: DataFrame, features: str, depth: int) -> DataFrame:
    """df with the packed table and `_at`: the place of each tree's leaf. A value equal to the split goes left."""
    rows = df.join(F.broadcast(_packed(nodes)))  # one row, as large as the ensemble

    def leaf(root: Column) -> Column:
        def down(at: Column, _) -> Column:
            feature = F.get(F.col("_feature"), at)
            left = F.get(F.col(features), feature).cast("double") <= F.get(F.col("_split"), at)
            step = F.when(left, F.get(F.col("_left_node"), at)).otherwise(F.get(F.col("_right_node"), at))
            return F.when(feature < 0, at).otherwise(root + step).cast("int")

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), root, down)

    return rows.withColumn("_at", F.transform("_roots", leaf))


def with_leaves(df: DataFrame, nodes: DataFrame, features: str, depth: int, out: str = "leaves") -> DataFrame:
    """df with the leaf (node number) it reaches in each tree."""
    rows = _places(df, nodes, features, depth)
    return rows.withColumn(out, F.zip_with("_at", "_roots", lambda at, root: at - root)).drop("_at", *_PACKED)


def class_probabilities(df: DataFrame, nodes: DataFrame, features: str, depth: int, out: str = "probs", smooth: float = 0.0) -> DataFrame:
    """df with the mean over trees of the class shares in its leaves. smooth is added to every class count."""
    rows = _places(df, nodes, features, depth)

    def shares(at: Column) -> Column:
        counts = F.transform(F.get(F.col("_counts"), at), lambda n: n + smooth)
        total = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
        return F.transform(counts, lambda n: F.when(total > 0, n / total).otherwise(0.0))

    zero = F.transform(F.get(F.col("_counts"), F.lit(0)), lambda _: F.lit(0.0))
    summed = F.aggregate("_at", zero, lambda acc, at: F.zip_with(acc, shares(at), lambda a, b: a + b))
    return rows.withColumn(out, F.transform(summed, lambda p: p / F.size("_roots"))).drop("_at", *_PACKED)


def boosted_probability(df: DataFrame, nodes: DataFrame, features: str, depth: int, out: str = "prob") -> DataFrame:
    """df with the probability of class 1 by a boosted table: counts[0] is a leaf's value, the margin counts twice."""
    rows = _places(df, nodes, features, depth)
    margin = F.aggregate("_at", F.lit(0.0), lambda a, at: a + F.get(F.col("_weight"), at) * F.get(F.get(F.col("_counts"), at), F.lit(0)))
    return rows.withColumn(out, 1 / (1 + F.exp(-2 * margin))).drop("_at", *_PACKED)


def as_boosted(nodes: DataFrame, step: float = 0.1) -> DataFrame:
    """A two-class counted forest as a boosted one: a leaf's value is half the log odds of its smoothed counts, each tree weighs step."""
    value = F.log((F.col("counts")[1] + 1) / (F.col("counts")[0] + 1)) / 2
    return nodes.withColumn("counts", F.array(value)).withColumn("weight", F.lit(step))


def average_path(n: Column) -> Column:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    return F.when(n > 2, 2 * (F.log(n - 1) + EULER) - 2 * (n - 1) / n).when(n == 2, 1.0).otherwise(0.0)


def isolation_score(df: DataFrame, nodes: DataFrame, features: str, depth: int, out: str = "score") -> DataFrame:
    """df with -2 ** -(mean path / expected path) by how few rows share its leaves in complete trees: lower is more unusual."""
    rows = _places(df, nodes, features, depth)
    size = lambda at: F.aggregate(F.get(F.col("_counts"), at), F.lit(0.0), lambda a, n: a + n)
    paths = F.aggregate("_at", F.lit(0.0), lambda a, at: a + depth + average_path(size(at)))
    expected = average_path(size(F.get(F.col("_roots"), F.lit(0))))
    return rows.withColumn(out, -F.pow(F.lit(2.0), -(paths / F.size("_roots")) / expected)).drop("_at", *_PACKED)


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance): Gini decrease of its splits, as shares of each tree, averaged over trees."""
    total = F.aggregate("counts", F.lit(0.0), lambda a, n: a + n)
    gini = 1 - F.aggregate("counts", F.lit(0.0), lambda a, n: a + n * n) / (F.col("n") * F.col("n"))
    told = nodes.withColumn("n", total).withColumn("mass", F.when(F.col("n") > 0, F.col("n") * gini).otherwise(0.0))
    below = lambda side: told.select("tree", F.col("node").alias(f"{side}_node"), F.col("mass").alias(f"{side}_mass"))
    gains = told.where("feature >= 0").join(below("left"), ["tree", "left_node"]).join(below("right"), ["tree", "right_node"]).select(
        "tree", "feature", (F.col("mass") - F.col("left_mass") - F.col("right_mass")).alias("gain"))
    trees = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
    count = nodes.agg(F.countDistinct("tree").alias("trees"))
    return gains.join(trees, "tree").join(F.broadcast(count)).groupBy("feature").agg(
        F.sum(F.when(F.col("all") > 0, F.col("gain") / F.col("all") / F.col("trees")).otherwise(0.0)).alias("importance"))
