"""Binary and multiclass metrics, score curves and threshold calibration.

All groups are measured in one job. Curves first collapse to one row per score; running counts are
taken inside ranges of scores and shifted by the totals of the ranges above, so that no window spans
all scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import materialize

#: Distinct scores of a range that running counts are taken in.
RANGE = 200_000


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion(df: DataFrame, y: str, pred: str, by: list[str] = ()) -> DataFrame:
    t, p = F.col(y) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
    )


def rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = counts.withColumns({
        "total": tp + fp + fn + tn, "benign": tn + fp, "malicious": tp + fn,
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn), "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": _ratio(tn, tn + fp), "fpr": _ratio(fp, tn + fp), "fnr": _ratio(fn, tp + fn),
    })
    return out


def binary_metrics(df: DataFrame, y: str, pred: str, by: list[str] = ()) -> DataFrame:
    return rates(confusion(df, y, pred, by))


def score_counts(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    """Per score the positives and negatives at it and at or above it. Rows without a score do not count; null is a group
    like any other.

    Distinct scores are written first. Where there are many, they are dealt into ranges whose number follows theirs, and each
    range's running counts are moved on by the totals of the ranges above.
    """
    by = list(by)
    at = materialize(df.where(F.col(prob).isNotNull() & ~F.isnan(prob)).groupBy(*by, F.col(prob).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")), "scores")
    ranges = -(-at.count() // RANGE)
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_k{i}") for i, c in enumerate(by)] \
        + [F.col(c).isNull().alias(f"_n{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))] + [f"_n{i}" for i in range(len(by))]
    at = at.select("*", *keys)
    if ranges <= 1:
        whole = Window.partitionBy(*names or [F.lit(0)])
        w = whole.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
        return at.select(*by, "threshold", "pos", "neg", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                         F.sum("pos").over(whole).alias("n_pos"), F.sum("neg").over(whole).alias("n_neg"))
    at = materialize(at.repartitionByRange(ranges, "threshold").withColumn("_bucket", F.spark_partition_id()), "ranges")
    totals = at.groupBy(*names, "_bucket").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    above = Window.partitionBy(*names or [F.lit(0)]).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*names or [F.lit(0)])
    offsets = totals.select(
        *names, "_bucket",
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_tp0"),
        F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_fp0"),
        F.sum("_pos").over(whole).alias("n_pos"), F.sum("_neg").over(whole).alias("n_neg"),
    )
    w = Window.partitionBy(*names, "_bucket").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    return at.join(offsets, [*names, "_bucket"]).select(
        *by, "threshold", "pos", "neg",
        (F.col("_tp0") + F.sum("pos").over(w)).alias("tp"),
        (F.col("_fp0") + F.sum("neg").over(w)).alias("fp"), "n_pos", "n_neg",
    )


def roc_curve(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    """True and false positive rate when everything scored at or above the threshold is flagged."""
    return score_counts(df, y, prob, by).select(
        *by, "threshold", (F.col("tp") / F.col("n_pos")).alias("tpr"), (F.col("fp") / F.col("n_neg")).alias("fpr")
    )


def pr_curve(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    return score_counts(df, y, prob, by).select(
        *by, "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("n_pos")).alias("recall"),
    )


def roc_auc(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    """Area under ROC: each score's trapezoid over its own negatives. Null when a class is absent."""
    c = score_counts(df, y, prob, by)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    n = F.first("n_pos").cast("double") * F.first("n_neg")
    return c.groupBy(*by).agg(F.when(n > 0, area / n).alias("roc_auc"))


def average_precision(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    c = score_counts(df, y, prob, by)
    total = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    n = F.first("n_pos")
    return c.groupBy(*by).agg(F.when(n > 0, total / n).alias("average_precision"))


def areas(df: DataFrame, y: str, prob: str, by: list[str] = ()) -> DataFrame:
    """Area under ROC and average precision from one table of scores. Null when the class they need is absent."""
    c = score_counts(df, y, prob, by)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    precise = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    n_pos, n = F.first("n_pos"), F.first("n_pos").cast("double") * F.first("n_neg")
    return c.groupBy(*by).agg(F.when(n > 0, area / n).alias("roc_auc"), F.when(n_pos > 0, precise / n_pos).alias("average_precision"))


def _clamp(threshold: Column) -> Column:
    return F.greatest(F.lit(0.35), F.least(F.lit(0.65), threshold))


def _f1_rows(df: DataFrame, y: str, prob: str) -> DataFrame:
    c = score_counts(df, y, prob)
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / F.col("n_pos")
    return c.select("threshold", r.alias("recall"), (2 * p * r / (p + r + 1e-10)).alias("f1"),
                    (F.col("fp") / F.col("n_neg")).alias("fpr"))


def calibrate(df: DataFrame, y: str, prob: str, method: str = "f1") -> DataFrame:
    """One row: method, clamped threshold, and the F1 at the score nearest to it.

    'f1': highest F1 among scores with recall of at least 0.70, lowest such score; if there is
    none, among all. 'recall_fpr': lowest false positive rate with recall of at least 0.90,
    highest such score; 0.5 if there is none.
    """
    curve = _f1_rows(df, y, prob)
    # Ties of equal F1 differ in the last bits between engines: compare to twelve digits.
    f1 = F.round("f1", 12)
    if method == "f1":
        viable = F.col("recall") >= 0.70
        order = F.struct(f1, -F.col("threshold"))
        best = F.coalesce(
            F.max_by("threshold", F.when(viable, order)), F.max_by("threshold", order), F.lit(0.5)
        )
    elif method == "recall_fpr":
        order = F.when(F.col("recall") >= 0.90, F.struct(-F.col("fpr"), F.col("threshold")))
        best = F.coalesce(F.max_by("threshold", order), F.lit(0.5))
    else:
        best = F.lit(0.5)
    chosen = curve.agg(_clamp(best).alias("chosen")).scalar()
    # Distances to ten digits, so that two scores equally near the threshold tie and the lower wins.
    distance = F.round(F.abs(F.col("threshold") - chosen), 10)
    return curve.agg(
        F.lit(method).alias("method"), F.first(chosen).alias("threshold"),
        F.min_by("f1", F.struct(distance, F.col("threshold"))).alias("f1_at_threshold"),
    )


def multiclass_f1(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Accuracy, macro and weighted F1 over the classes seen in truth or prediction."""
    hit = F.count_if(F.col(y) == F.col(pred))
    truth = df.groupBy(F.col(y).alias("cls")).agg(F.count(F.lit(1)).alias("support"), hit.alias("tp"))
    said = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    per = truth.join(said, "cls", "full_outer").na.fill(0)
    f1 = _ratio(2.0 * F.col("tp"), F.col("support") + F.col("predicted"))
    return per.withColumn("f1", f1).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def better_model(scores: DataFrame, y: str, probs: dict[str, str], preferred: str) -> DataFrame:
    """Metrics of each model at 0.5 and whether it is chosen: highest F1, ties to `preferred`."""
    long = scores.select(F.col(y).alias("y"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), (F.col(c) >= 0.5).cast("int").alias("pred")) for m, c in probs.items()
    ])))
    m = binary_metrics(long, "y", "pred", ["model"])
    best = m.agg(F.max_by("model", F.struct(F.round("f1", 12), F.col("model") == preferred))).scalar()
    return m.withColumn("chosen", F.col("model") == best)


def generalization(df: DataFrame, y: str, pred: str, by: list[str]) -> DataFrame:
    """Per group the flows and seven rates in percent."""
    m = binary_metrics(df, y, pred, by)
    names = ["accuracy", "precision", "recall", "f1", "specificity", "fpr", "fnr"]
    return m.select(*by, F.col("total").alias("flows"), *[(100 * F.col(n)).alias(f"{n}_pct") for n in names])
