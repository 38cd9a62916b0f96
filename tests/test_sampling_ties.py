from pyspark.sql import functions as F

from flowspark.operators import sampling


def test_equal_rows_are_counted_before_they_are_ranked(spark):
    """A flood of equal rows in one class: as many of them as the cap asks for, and the plan ranks distinct rows only."""
    flood = spark.range(200_000).select(F.lit("a").alias("c"), F.lit(7).alias("x"), F.lit(-0.0).alias("d"))
    others = spark.range(50).select(F.lit("b").alias("c"), F.col("id").cast("int").alias("x"), F.lit(1.0).alias("d"))
    df = flood.unionByName(others).withColumn("row", F.sha2(F.concat_ws("|", "c", "x"), 256))
    got = sampling.cap_per_class(df, ["c"], 1000, 1, "row")
    assert {r.c: r["count"] for r in got.groupBy("c").count().collect()} == {"a": 1000, "b": 50}
    assert got.columns == df.columns and got.where("c = 'a'").distinct().count() == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate")  # what is ranked has been aggregated


def test_rows_with_one_id_and_different_content_stay_whole(spark):
    rows = [("a", i % 5, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "c string, id int, v string")
    got = sampling.cap_per_class(df, ["c"], 17, 3, "id").collect()
    assert len(got) == 17 and len({r.v for r in got}) == 17
    assert {tuple(r) for r in got} <= set(rows)
