"""Report queries over scored flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW = [
    "Predicted_Verdict", "Predicted_Category", "Threat_Confidence_%", "Risk_Level", "Destination Port", "Flow Duration",
    "Total Fwd Packets", "Packet Length Mean", "OOD_Score",
]


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def _threat(verdict: str) -> Column:
    return F.col(verdict) == "MALICIOUS"


def scan_kpis(scored: DataFrame, verdict: str = "Predicted_Verdict", by: list[str] = ()) -> DataFrame:
    k = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_threat(verdict)).alias("threats"),
        F.count_if(~_threat(verdict)).alias("benign"),
    ).withColumn("threat_pct", _pct(F.col("threats"), F.col("total")))
    return k.withColumn("posture", F.when(F.col("threat_pct") > 30, "CRITICAL").when(
        F.col("threat_pct") > 0, "ELEVATED").otherwise("NORMAL"))


def capture_report(scored: DataFrame, capture: str, verdict: str, expected: str) -> DataFrame:
    """Per capture the flows by verdict; detection rate of malicious captures, else false positives."""
    k = scored.groupBy(capture, expected).agg(
        F.count(F.lit(1)).alias("flows"), F.count_if(_threat(verdict)).alias("malicious")
    )
    pct = _pct(F.col("malicious"), F.col("flows"))
    bad = F.lower(expected) == "malicious"
    return k.withColumns({
        "benign": F.col("flows") - F.col("malicious"), "malicious_pct": pct,
        "benign_pct": _pct(F.col("flows") - F.col("malicious"), F.col("flows")),
        "detection_rate": F.when(bad, pct), "false_positive_rate": F.when(~bad, pct),
    })


def confidence_stats(scored: DataFrame, capture: str, confidence: str) -> DataFrame:
    """Confidences have two decimals, so a capture has at most 10 001 of them to take the median of."""
    at = scored.groupBy(capture, confidence).agg(F.count(F.lit(1)).alias("n"))
    c = F.col(confidence)
    return at.groupBy(capture).agg(
        (F.sum(c * F.col("n")) / F.sum("n")).alias("mean"), F.percentile(c, F.lit(0.5), F.col("n")).alias("median"),
        F.max(c).alias("max"), F.min(c).alias("min"),
    )


def category_counts(scored: DataFrame, category: str = "Predicted_Category", by: list[str] = ()) -> DataFrame:
    return scored.groupBy(*by, category).agg(F.count(F.lit(1)).alias("flows")).orderBy(*by, F.desc("flows"), category)


def capture_kpis(flows: DataFrame, capture: str = "capture_id", verdict: str = "Predicted_Verdict") -> DataFrame:
    return flows.groupBy(capture).agg(
        F.sum("Packets").alias("packets"), F.count(F.lit(1)).alias("flows"),
        F.count_if(_threat(verdict)).alias("threats"), F.count_if(~_threat(verdict)).alias("benign"),
        (F.sum("Bytes") / 1024).alias("kilobytes"),
    )


def by_verdict(scored: DataFrame, choice: str, verdict: str = "Predicted_Verdict") -> DataFrame:
    """`choice`: all, threats or benign."""
    if choice == "all":
        return scored
    return scored.where(F.col(verdict) == {"threats": "MALICIOUS", "benign": "BENIGN"}[choice])


def preview(scored: DataFrame, first: list[str] = ()) -> DataFrame:
    return scored.select(*[F.col(f"`{c}`") for c in [*first, *PREVIEW] if c in scored.columns])


def top_talkers(flows: DataFrame, by: list[str], k: int) -> DataFrame:
    return flows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("flows"), F.sum("Packets").alias("packets"), F.sum("Bytes").alias("bytes")
    ).orderBy(F.desc("packets"), *by).limit(k)
