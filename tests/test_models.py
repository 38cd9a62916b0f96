import numpy as np
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.operators import isolation, models, score

SMALL = models.TrainConfig(rf_trees=4, rf_depth=4, rf_min_leaf=1, gbt_rounds=3, gbt_depth=3, isolation_trees=10, anomaly_from=10)


def labeled(spark, n=240):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        bad, kind = i % 2, ("DoS", "PortScan")[i // 2 % 2]
        values = [float(v) for v in rng.normal(0, 1, len(FEATURES))]
        values[1] += 6 * bad
        values[2] += 6 * (bad and kind == "DoS")
        rows.append((i, "d", bad, kind if bad else "Benign", *values))
    ddl = "row_id int, dataset string, target int, category string, " + ", ".join(f"`{f}` double" for f in FEATURES)
    return spark.createDataFrame(rows, ddl)


def test_train_save_load_score(spark, tmp_path):
    df = labeled(spark)
    detector, rows = models.train(df, FEATURES, "target", "category", "row_id", ["dataset"], SMALL)
    assert 0.35 <= detector.threshold <= 0.65 and detector.attack_classes == ["DoS", "PortScan"]
    assert {r.split: r["count"] for r in rows.groupBy("split").count().collect()} == {"test": 48, "val": 24, "train": 168}
    detector.save(str(tmp_path / "m"))
    loaded = models.Detector.load(str(tmp_path / "m"))
    scored = loaded.transform(df, strict=True)
    assert scored.count() == df.count() and scored.columns[:len(df.columns)] == df.columns
    right = scored.where((F.col("Predicted_Verdict") == "MALICIOUS") == (F.col("target") == 1)).count()
    assert right > 0.9 * df.count()
    a = detector.transform(df).orderBy("row_id").select("`Threat_Confidence_%`", "OOD_Score", "Predicted_Category").collect()
    assert a == scored.orderBy("row_id").select("`Threat_Confidence_%`", "OOD_Score", "Predicted_Category").collect()


def test_isolation_finds_the_odd_row(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(400)] + [(999, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "row_id int, x array<double>")
    trees = isolation.fit(df.where("row_id < 999"), "row_id", "x", trees=20)
    assert trees.groupBy("tree").count().count() == 20 and trees.count() <= 20 * 2 * isolation.PSI
    scored = df.select("row_id", isolation.scorer(trees)(F.col("x")).alias("s")).orderBy("s")
    assert scored.first().row_id == 999 and scored.first().s < -0.6


def test_few_ordinary_rows_are_not_unusual(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(40)], "row_id int, x array<double>")
    scores = [r.s for r in df.select(isolation.scorer(isolation.fit(df, "row_id", "x", 20))(F.col("x")).alias("s")).collect()]
    assert np.mean(scores) > -0.5 and all(-1 <= v <= 0 for v in scores)
    assert isolation.fit(df.limit(0), "row_id", "x") is None


def test_columns_may_be_absent_reordered_or_bad(spark):
    df = labeled(spark).withColumn("capture_id", F.concat(F.lit("c"), F.col("row_id") % 12))
    few = [FEATURES[2], FEATURES[1], FEATURES[5]]
    detector, _ = models.train(df, few, "target", "category", "row_id", ["dataset"], SMALL)
    n = df.count()
    want = detector.transform(df).orderBy("row_id").select("`Threat_Confidence_%`").collect()
    turned = df.select("row_id", F.col(f"`{few[1]}`"), F.col(f"`{few[2]}`"), F.col(f"`{few[0]}`"))
    assert detector.transform(turned).orderBy("row_id").select("`Threat_Confidence_%`").collect() == want
    assert detector.transform(df.drop(few[0])).count() == n
    assert detector.transform(df.withColumn(few[0], F.lit(None).cast("double"))).count() == n
    assert detector.transform(df.withColumn(few[0], F.lit("x"))).where("Predicted_Verdict IS NULL").count() == 0


def test_captures_stay_whole_and_held_out_rows_never_train(spark):
    df = labeled(spark).withColumns({
        "capture": F.concat(F.lit("c"), F.col("row_id") % 24), "fam": F.when(F.col("row_id") % 24 == 5, "Zeus").otherwise("x")})
    cfg = models.TrainConfig(**{**SMALL.__dict__, "held_out": ("Zeus",), "capture_datasets": ("d",), "fit_rows": 40, "anomaly_from": 100})
    detector, rows = models.train(df, FEATURES, "target", "category", "row_id", ["dataset"], cfg, group="capture", family="fam")
    assert rows.count() == df.count() and rows.where("fam = 'Zeus' AND split <> 'held_out'").isEmpty()
    assert rows.where("split <> 'held_out'").groupBy("capture").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    assert detector.trees is None  # fewer than a hundred benign training rows
    report = {(r.scope, r["name"]): r for r in models.run_metrics(detector, rows, "target", "category", "dataset", "fam").collect()}
    assert set(report) == {("test", "all"), ("dataset", "d"), ("held_out_family", "Zeus")}
    assert report["held_out_family", "Zeus"].total == 10 and report["test", "all"].f1 > 0.8
    assert models.family_metrics(detector, rows, "target", "category").first().accuracy > 0.5


def test_training_table(spark):
    raw = spark.createDataFrame([(1, "80", "inf", "10.0.0.1", "MALICIOUS", None, None, "D"), (2, "x", "5", "10.0.0.2", "BENIGN", "BENIGN", "c1", None)],
                                "id int, `Dst Port` string, flow_duration string, `Source IP` string, Binary_Label string, Attack_Category string, Capture_ID string, Dataset string")
    rows = {r.id: r for r in models.training_table(raw, "id").collect()}
    assert (rows[1].target, rows[1].attack_category, rows[1].split_group, rows[1]["Flow Duration"], rows[1]["Destination Port"]) == (1, "Unknown Malicious", "D", 0.0, 80.0)
    assert (rows[2].target, rows[2].attack_category, rows[2].split_group, rows[2]["Flow Duration"]) == (0, "Benign", "c1", 5.0)
    assert set(FEATURES) <= set(rows[1].asDict()) and "Source IP" not in rows[1].asDict()


def test_scaler_leaves_constant_columns_alone(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in models.scale(df, models.fit_scaler(df, ["a", "b"])).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_verdict_edges(spark):
    df = spark.createDataFrame([(0.2499,), (0.25,), (0.6,), (0.85,)], "p double")
    rows = score.verdicts(df, "p", 0.6).collect()
    assert [r.Predicted_Verdict for r in rows] == ["BENIGN", "BENIGN", "MALICIOUS", "MALICIOUS"]
    assert [r.Risk_Level.split()[0] for r in rows] == ["LOW", "MODERATE", "HIGH", "CRITICAL"]
