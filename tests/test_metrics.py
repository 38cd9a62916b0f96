import random

import pytest
from pyspark.sql import functions as F

from flowspark.operators import metrics as mx


def frame(spark, rows):
    return spark.createDataFrame(rows, "y int, prob double, g string")


def test_confusion_adds_up_and_single_class_works(spark):
    df = frame(spark, [(0, 0.2, "a"), (0, 0.9, "a"), (0, 0.1, "b")]).selectExpr("*", "int(prob >= 0.5) as pred")
    one = mx.binary_metrics(df, "y", "pred").first()
    assert (one.tn, one.fp, one.fn, one.tp) == (2, 1, 0, 0)
    assert one.recall == 0 and one.precision == 0 and one.fnr == 0 and one.fpr == pytest.approx(1 / 3)
    assert mx.roc_auc(df, "y", "prob").first().roc_auc is None


def test_curves_match_pairs_and_ties(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1), rng.choice("ab")) for _ in range(300)]
    got = {r.g: r for r in mx.roc_auc(frame(spark, rows), "y", "prob", ["g"]).collect()}
    for g in "ab":
        pos = [p for y, p, k in rows if y and k == g]
        neg = [p for y, p, k in rows if not y and k == g]
        pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[g].roc_auc == pytest.approx(pairs / len(pos) / len(neg))
    ranked = sorted({p for _, p, _ in rows}, reverse=True)
    total, tp_before, ap = sum(y for y, _, _ in rows), 0, 0.0
    for t in ranked:
        tp, n = sum(y for y, p, _ in rows if p >= t), sum(1 for _, p, _ in rows if p >= t)
        ap += (tp - tp_before) / total * tp / n
        tp_before = tp
    assert mx.average_precision(frame(spark, rows), "y", "prob").first()[0] == pytest.approx(ap)


def test_calibration_is_clamped(spark):
    low = frame(spark, [(1, 0.1, "")] * 5 + [(0, 0.05, "")] * 5)
    assert mx.calibrate(low, "y", "prob").first().threshold == 0.35
    mid = frame(spark, [(1, 0.6, "")] * 9 + [(1, 0.2, "")] + [(0, 0.4, "")] * 10)
    assert mx.calibrate(mid, "y", "prob").first().threshold == 0.6
    assert mx.calibrate(mid, "y", "prob", "recall_fpr").first().threshold == 0.6


def test_multiclass(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "d")], "y string, p string")
    r = mx.multiclass_f1(df, "y", "p").first()
    assert r.accuracy == 0.5 and r.macro_f1 == pytest.approx((2 / 3 + 2 / 3) / 4) and r.weighted_f1 == pytest.approx((2 / 3 * 2 + 2 / 3) / 4)


def test_scores_crowded_together_are_dealt_evenly(spark):
    """99 % of the scores below 1/4096: no range of scores holds more than a few hundredths of them."""
    n = 20_000
    rows = spark.range(n).select((F.col("id") % 2).alias("y"), F.when(F.col("id") % 100 == 0, F.col("id") / n).otherwise(F.col("id") / n / 4096).alias("p"))
    counted = mx.score_counts(rows, "y", "p")
    assert counted.count() == rows.select("p").distinct().count()
    top = counted.orderBy(F.desc("tp"), F.desc("fp")).first()
    assert (top.tp, top.fp) == (n // 2, n // 2)
    assert "_bucket" not in counted.columns


def test_null_groups_and_scores(spark):
    rows = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.2), ("a", 0, 0.3), ("a", 1, None)], "g string, y int, p double")
    got = {r.g: (r.roc_auc, r.average_precision) for r in mx.areas(rows, "y", "p", ["g"]).collect()}
    assert got == {None: (1.0, 1.0), "a": (0.0, 0.5)}


def test_ranges_follow_the_scores(spark, monkeypatch):
    n = 6000
    rows = spark.range(n).select((F.col("id") % 3 % 2).alias("y"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit("g")).alias("g"),
                                 F.round(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100_000, 5).alias("p"))
    whole = sorted(map(tuple, mx.score_counts(rows, "y", "p", ["g"]).collect()), key=str)
    areas = mx.areas(rows, "y", "p").first()
    dealt = {}
    keep = mx.materialize

    def watched(df, name):
        dealt[name] = keep(df, name)
        return dealt[name]

    monkeypatch.setattr(mx, "materialize", watched)
    for size in (1000, 400):
        monkeypatch.setattr(mx, "RANGE", size)
        assert sorted(map(tuple, mx.score_counts(rows, "y", "p", ["g"]).collect()), key=str) == whole
        sizes = [r["count"] for r in dealt["ranges"].groupBy("_bucket").count().collect()]
        assert len(sizes) >= len(whole) // size and max(sizes) < 2 * size
    again = mx.areas(rows, "y", "p").first()
    assert again.roc_auc == pytest.approx(areas.roc_auc) and again.average_precision == pytest.approx(areas.average_precision)
