"""Verdict, confidence, risk and category columns from model probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound of the malicious probability -> risk level.
RISK_LEVELS = [
    (0.25, "LOW (Normal Flow)"), (0.60, "MODERATE (Suspicious Pattern)"), (0.85, "HIGH (Likely Threat)"),
]
RISK_TOP = "CRITICAL (Active Attack)"
RISK_OOD = "MODERATE (Unusual Pattern - OOD)"
OOD_LIMIT = -0.5
CATEGORY_MIN = 0.30
VERDICT_TEXT = {1: "MALICIOUS (THREAT DETECTED)", 0: "BENIGN (SAFE TRAFFIC)"}


def risk_level(prob: Column) -> Column:
    out = F
    for bound, name in RISK_LEVELS:
        out = out.when(prob < bound, name)
    return out.otherwise(RISK_TOP)


def verdicts(df: DataFrame, prob: str, threshold: float) -> DataFrame:
    p = F.col(prob)
    return df.withColumns({
        "Predicted_Verdict": F.when(p >= threshold, "MALICIOUS").otherwise("BENIGN"),
        "Threat_Confidence_%": F.round(p * 100, 2),
        "Risk_Level": risk_level(p),
    })


def argmax_class(probs: Column, classes: list[str]) -> Column:
    """Class of the highest probability, the first of equals."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.element_at(names, F.array_position(probs, F.array_max(probs)).cast("int"))


def attack_category(df: DataFrame, is_threat: Column, probs: str, classes: list[str],
                    least: float = CATEGORY_MIN) -> DataFrame:
    p = F.col(probs)
    known = F.when(F.array_max(p) >= least, argmax_class(p, classes)).otherwise("Unknown Malicious")
    return df.withColumns({
        "Predicted_Category": F.when(is_threat, known).otherwise("Benign"),
        "category_confidence": F.when(is_threat, F.array_max(p)).otherwise(F.lit(0.0)),
    })


def ood_override(df: DataFrame, is_threat: Column, ood: str, risk: str = "Risk_Level") -> DataFrame:
    """Benign flows with an unusual pattern are raised to a moderate risk with a warning."""
    odd = ~is_threat & (F.col(ood) < OOD_LIMIT)
    return df.withColumns({
        risk: F.when(odd, RISK_OOD).otherwise(F.col(risk)), "ood_warning": F.coalesce(odd, F.lit(False)),
    })


def verdict_records(df: DataFrame, prob: str, threshold: float, ood: str | None = None,
                    category: Column | None = None, keep: list[str] = ()) -> DataFrame:
    """The full verdict of each flow, the answer given for a single one."""
    p = F.col(prob)
    threat = p >= threshold
    out = df.select(
        *keep,
        F.when(threat, VERDICT_TEXT[1]).otherwise(VERDICT_TEXT[0]).alias("verdict"),
        threat.alias("is_threat"),
        F.when(threat, category if category is not None else F.lit("Unknown Malicious")).otherwise("Benign")
        .alias("predicted_category"),
        F.round(p * 100, 2).alias("threat_confidence"),
        F.round((1 - p) * 100, 2).alias("benign_confidence"),
        risk_level(p).alias("risk_level"),
        F.lit(threshold).alias("binary_threshold"),
        F.create_map(F.lit("BENIGN"), F.round(1 - p, 4), F.lit("MALICIOUS"), F.round(p, 4)).alias("class_probabilities"),
        *([F.round(ood, 4).alias("ood_score")] if ood else []),
    )
    return ood_override(out, F.col("is_threat"), "ood_score", "risk_level") if ood else out


def collapse_multiclass(df: DataFrame, probs: str, classes: list[str]) -> DataFrame:
    """Verdict from a multiclass model that may have a BENIGN class."""
    p = F.col(probs)
    label = argmax_class(p, classes)
    threat_prob = 1 - p[classes.index("BENIGN")] if "BENIGN" in classes else F.array_max(p)
    return df.withColumns({
        "Predicted_Category": label,
        "Predicted_Verdict": F.when(label == "BENIGN", "BENIGN").otherwise("MALICIOUS"),
        "threat_prob": threat_prob,
    }).withColumns({
        "Threat_Confidence_%": F.round(F.col("threat_prob") * 100, 2), "Risk_Level": risk_level(F.col("threat_prob")),
    })


def model_info(metadata: DataFrame) -> DataFrame:
    """Model description with defaults for what older metadata lacks."""
    defaults = {
        "binary_model_type": "Unknown", "training_date": "Unknown", "schema_version": "1.0", "binary_threshold": 0.5,
    }
    have = set(metadata.columns)
    others = [c for c in metadata.columns if c not in defaults]
    return metadata.select(*others, *[
        (F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v)).alias(c) for c, v in defaults.items()
    ])
