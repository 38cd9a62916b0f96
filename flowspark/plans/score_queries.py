"""Sampling, verdicts, metrics and reports (inventory sections F, H, I and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowspark.operators import metrics as mx
from flowspark.operators import reports, sampling, score
from flowspark.operators import features as fx
from flowspark.operators import models
from flowspark.operators import normalize as nz
from flowspark.plans.flow_queries import CFG, _LENGTHS, _flow_rows
from flowspark.plans.registry import query, rounded
from flowspark.plans.views import duck, table, view
from flowspark.session import scratch_path
from flowspark.sources import tables

_S = duck("scored")
SEED = 42


def _h(seed, col: str = "row_id") -> str:
    return f"md5(concat('{seed}|', cast({col} AS VARCHAR)))"


def _lowest(source: str, by: str, limit: str, seed, cols: str = "*") -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {_h(seed)}, row_id) AS rn FROM {source}) "
            f"WHERE rn <= {limit}")


# ---- sampling ----------------------------------------------------------------------------------


@query("sample_cap_per_class", _S + _lowest("scored", "category", "500", SEED, "row_id, category"))
def sample_cap_per_class(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "category")
    return sampling.cap_per_class(rows, ["category"], 500, SEED, "row_id")


@query("sample_cap_null_class", _S.rstrip() + ", a AS (SELECT row_id, nullif(category, 'DoS') AS category FROM scored) "
       + _lowest("a", "category", "300", SEED, "row_id, category"))
def sample_cap_null_class(spark, sf):
    """A missing class is capped like any other."""
    rows = view(spark, sf, "scored").select("row_id", F.nullif("category", F.lit("DoS")).alias("category"))
    return sampling.cap_per_class(rows, ["category"], 300, SEED, "row_id")


@query("sample_two_level", _S.rstrip() + ", a AS (" + _lowest("scored", "capture_id, category", "150", "42a", "row_id, capture_id, category")
       + ") " + _lowest("a", "category", "CASE WHEN category = 'Malware' THEN 900 ELSE 400 END", "42b", "row_id, capture_id, category"))
def sample_two_level(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "capture_id", "category")
    return sampling.two_level_cap(rows, "capture_id", "category", 150, "Malware", 900, 400, SEED, "row_id")


@query("sample_n", _S + f"SELECT row_id, dataset FROM scored ORDER BY {_h(SEED)}, row_id LIMIT 1000")
def sample_n(spark, sf):
    return sampling.sample_n(view(spark, sf, "scored").select("row_id", "dataset"), 1000, SEED, "row_id")


_QUOTA = {"DoS": 120, "DDoS": 100, "PortScan": 100, "Botnet": 45}


@query("sample_quota", _S + "SELECT row_id, category, capture_id, 'THREAT' AS expected_verdict FROM (" + _lowest(
    "scored WHERE category <> 'Malware'", "category", "CASE category WHEN 'DoS' THEN 120 WHEN 'Botnet' THEN 45 ELSE 100 END", SEED)
    + ") UNION ALL SELECT row_id, category, capture_id, 'BENIGN' FROM (" + _lowest(
    "(" + _lowest("scored WHERE category = 'Malware'", "capture_id", "60", "42a", "row_id, category, capture_id") + ")", "category", "500", "42b") + ")")
def sample_quota(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "category", "capture_id")
    return sampling.quota_sample(rows, "category", "capture_id", _QUOTA, "Malware", 500, 60, SEED, "row_id")


@query("head_per_group", _S + """SELECT row_id, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY row_id) AS rn
 FROM scored) WHERE rn <= 4""")
def head_per_group(spark, sf):
    return sampling.head_per_group(view(spark, sf, "scored").select("row_id", "category"), ["category"], 4, ["row_id"])


@query("hash_shuffle", _S + f"SELECT row_id, dataset, prob FROM scored ORDER BY {_h(SEED)}, row_id")
def hash_shuffle(spark, sf):
    return sampling.shuffle_rows(view(spark, sf, "scored").select("row_id", "dataset", "prob"), SEED, "row_id")


@query("union_misaligned", duck("scored", "doh_rows", "raw_labels") + """SELECT row_id, category, prob, NULL AS duration, NULL AS raw_label FROM scored
 UNION ALL SELECT row_id, NULL, NULL, Duration, NULL FROM doh_rows UNION ALL SELECT row_id, NULL, NULL, NULL, raw_label FROM raw_labels""")
def union_misaligned(spark, sf):
    return sampling.combine([
        view(spark, sf, "scored").select("row_id", "category", "prob"),
        view(spark, sf, "doh_rows").select("row_id", F.col("Duration").alias("duration")),
        view(spark, sf, "raw_labels"),
    ])


@query("exclude_families", _S + "SELECT row_id, specific_family FROM scored WHERE specific_family NOT IN ('F1', 'F4')")
def exclude_families(spark, sf):
    return sampling.exclude(view(spark, sf, "scored").select("row_id", "specific_family"), "specific_family", ["F1", "F4"])


def _held(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "specific_family")
    listed = rows.where(F.col("specific_family").isin("F2", "F5", "F9"))
    return sampling.hold_out(rows, "specific_family", listed)


_HELD = "('F2', 'F5', 'F9')"
query("heldout_semi", _S + f"SELECT row_id, specific_family FROM scored WHERE specific_family IN {_HELD}")(lambda s, d: _held(s, d)[0])
query("heldout_anti", _S + f"SELECT row_id, specific_family FROM scored WHERE specific_family NOT IN {_HELD}")(lambda s, d: _held(s, d)[1])


_SPLIT_CASE = """CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test'
 WHEN rn <= ceil(n * 0.2::DOUBLE) + ceil((n - ceil(n * 0.2::DOUBLE)) * 0.125::DOUBLE) THEN 'val' ELSE 'train' END AS split"""


@query("split_stratified", _S + f"""SELECT row_id, dataset, y_true, {_SPLIT_CASE} FROM (SELECT *, row_number() OVER (PARTITION BY dataset, y_true
 ORDER BY {_h(SEED)}, row_id) AS rn, count(*) OVER (PARTITION BY dataset, y_true) AS n FROM scored)""")
def split_stratified(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "dataset", "y_true")
    return sampling.stratified_split(rows, ["dataset", "y_true"], 0.2, 0.1, SEED, "row_id")


def _captures(spark, sf):
    # Captures are of one class, so the class is part of the capture's name.
    rows = view(spark, sf, "scored").withColumn("capture_id", F.concat_ws("-", "capture_id", "y_true"))
    return rows.select("row_id", "dataset", "capture_id", "y_true")


_CAP = _S.rstrip() + """, c AS (SELECT row_id, dataset, concat(capture_id, '-', y_true) AS capture_id, y_true FROM scored),
k AS (SELECT dataset, capture_id, y_true, row_number() OVER (PARTITION BY dataset, y_true ORDER BY """ + _h(SEED, "capture_id") + """, capture_id) AS rn,
 count(*) OVER (PARTITION BY dataset, y_true) AS n FROM (SELECT DISTINCT dataset, capture_id, y_true FROM c)),
split_rows AS (SELECT c.row_id, c.dataset, c.capture_id, c.y_true, """ + _SPLIT_CASE + " FROM c JOIN k USING (dataset, capture_id, y_true)) "


@query("split_by_capture", _CAP + "SELECT * FROM split_rows")
def split_by_capture(spark, sf):
    return sampling.capture_split(_captures(spark, sf), "dataset", "capture_id", "y_true", 0.2, 0.1, SEED)


_GROUPS = _S.rstrip() + """, c AS (SELECT row_id, nullif(dataset, '1-URGENT') AS dataset, y_true, coalesce(CASE WHEN row_id % 3 <> 0
 THEN concat(capture_id, '-', y_true) END, nullif(dataset, '1-URGENT'), cast(row_id AS VARCHAR)) AS split_group FROM scored),
k AS (SELECT dataset, split_group, y_true, row_number() OVER (PARTITION BY dataset, y_true ORDER BY """ + _h(SEED, "split_group") + """, split_group) AS rn,
 count(*) OVER (PARTITION BY dataset, y_true) AS n FROM (SELECT DISTINCT dataset, split_group, y_true FROM c)),
g AS (SELECT c.*, """ + _SPLIT_CASE + """ FROM c JOIN k ON c.dataset IS NOT DISTINCT FROM k.dataset AND c.split_group = k.split_group
 AND c.y_true = k.y_true) """


def _grouped(spark, sf):
    rows = view(spark, sf, "scored").select(
        "row_id", F.nullif("dataset", F.lit("1-URGENT")).alias("dataset"), "y_true",
        F.when(F.col("row_id") % 3 != 0, F.concat_ws("-", "capture_id", "y_true")).alias("capture_id"))
    return nz.split_group(rows, "row_id").drop("capture_id")


@query("split_by_capture_group", _GROUPS + "SELECT * FROM g")
def split_by_capture_group(spark, sf):
    """Rows without a capture go with their dataset, rows without either alone; no row is lost."""
    return sampling.capture_split(_grouped(spark, sf), "dataset", "split_group", "y_true", 0.2, 0.1, SEED)


@query("train_split_plan", _GROUPS.rstrip() + """, s AS (SELECT row_id, dataset, y_true, split_group, """ + _SPLIT_CASE + """ FROM (SELECT *, row_number() OVER
 (PARTITION BY dataset, y_true ORDER BY """ + _h(SEED) + """, row_id) AS rn, count(*) OVER (PARTITION BY dataset, y_true) AS n FROM c))
SELECT row_id, dataset, y_true, split_group, split FROM g WHERE dataset IN ('2-HIGH', '5-LOW')
UNION ALL SELECT row_id, dataset, y_true, split_group, split FROM s WHERE coalesce(dataset, '') NOT IN ('2-HIGH', '5-LOW')""")
def train_split_plan(spark, sf):
    """Which split each row of a training table gets: two datasets by whole captures, the others by rows."""
    cfg = models.TrainConfig(capture_datasets=("2-HIGH", "5-LOW"), seed=SEED)
    return models.split_plan(_grouped(spark, sf), "row_id", "dataset", "split_group", "y_true", cfg)


@query("split_by_capture_possible", _CAP + """SELECT dataset, min(n) >= 2 AND count(*) = 2 AS by_capture FROM (SELECT dataset, y_true,
 count(DISTINCT capture_id) AS n FROM c GROUP BY dataset, y_true) GROUP BY dataset""")
def split_by_capture_possible(spark, sf):
    return sampling.capture_split_possible(_captures(spark, sf), "dataset", "capture_id", "y_true")


@query("split_leakage", _S + f"""SELECT capture_id, count(DISTINCT split) AS splits FROM (SELECT capture_id, {_SPLIT_CASE} FROM (SELECT *,
 row_number() OVER (PARTITION BY dataset, y_true ORDER BY {_h(SEED)}, row_id) AS rn, count(*) OVER (PARTITION BY dataset, y_true) AS n
 FROM scored)) GROUP BY capture_id HAVING count(DISTINCT split) > 1""")
def split_leakage(spark, sf):
    split = sampling.stratified_split(view(spark, sf, "scored"), ["dataset", "y_true"], 0.2, 0.1, SEED, "row_id")
    return sampling.leaking_captures(split, ["capture_id"])


@query("class_weight_ratio", _S + """SELECT b AS n_benign, m AS n_malicious, round(b / greatest(m, 1), 6) AS weight_ratio FROM
 (SELECT count(*) FILTER (y_true = 0) AS b, count(*) FILTER (y_true = 1) AS m FROM scored)""")
def class_weight_ratio(spark, sf):
    return rounded(sampling.class_weight(view(spark, sf, "scored"), "y_true"))


@query("composition_counts", _S + "SELECT dataset, y_true, category, count(*) AS rows FROM scored GROUP BY ROLLUP (dataset, y_true, category)")
def composition_counts(spark, sf):
    return sampling.composition(view(spark, sf, "scored"), "dataset", "y_true", "category")


@query("class_distribution_pct", _S + """SELECT category, count(*) AS rows, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS pct
 FROM scored GROUP BY category""")
def class_distribution_pct(spark, sf):
    return rounded(sampling.class_distribution(view(spark, sf, "scored"), "category"))


# ---- verdicts ----------------------------------------------------------------------------------

_RISK = """CASE WHEN prob < 0.25 THEN 'LOW (Normal Flow)' WHEN prob < 0.6 THEN 'MODERATE (Suspicious Pattern)'
 WHEN prob < 0.85 THEN 'HIGH (Likely Threat)' ELSE 'CRITICAL (Active Attack)' END"""
_VERDICT = "CASE WHEN prob >= 0.5996 THEN 'MALICIOUS' ELSE 'BENIGN' END"
_CONF = 'round(prob * 100, 2)'
THRESHOLD = 0.5996
CLASSES = ["DoS", "DDoS", "PortScan", "Botnet"]


def _scanned(spark, sf):
    return score.verdicts(view(spark, sf, "scored"), "prob", THRESHOLD)


@query("verdicts", _S + f'SELECT row_id, {_VERDICT} AS "Predicted_Verdict", {_CONF} AS "Threat_Confidence_%" FROM scored')
def verdicts(spark, sf):
    return _scanned(spark, sf).select("row_id", "Predicted_Verdict", "Threat_Confidence_%")


@query("risk_levels", _S + f'SELECT row_id, {_RISK} AS "Risk_Level" FROM scored')
def risk_levels(spark, sf):
    return _scanned(spark, sf).select("row_id", "Risk_Level")


def _class_probs(spark, sf):
    share = [((F.col("row_id") * k) % 101) / F.lit(101.0) * F.lit(0.5) for k in (7, 13, 29, 31)]
    return view(spark, sf, "scored").withColumn("probs", F.array(*share))


_PROBS = _S.rstrip() + ", pr AS (SELECT *, [" + ", ".join(
    f"((row_id * {k}) % 101) / 101.0::DOUBLE * 0.5::DOUBLE" for k in (7, 13, 29, 31)) + "] AS probs FROM scored) "
_ARGMAX = "['DoS', 'DDoS', 'PortScan', 'Botnet'][list_position(probs, list_max(probs))]"


@query("attack_category_argmax", _PROBS + f"""SELECT row_id, CASE WHEN prob < 0.5996 THEN 'Benign' WHEN list_max(probs) >= 0.3 THEN {_ARGMAX}
 ELSE 'Unknown Malicious' END AS "Predicted_Category", round(CASE WHEN prob < 0.5996 THEN 0 ELSE list_max(probs) END, 6) AS category_confidence FROM pr""")
def attack_category_argmax(spark, sf):
    out = score.attack_category(_class_probs(spark, sf), F.col("prob") >= THRESHOLD, "probs", CLASSES)
    return rounded(out.select("row_id", "Predicted_Category", "category_confidence"))


_OOD = "-((row_id * 37) % 100) / 100.0::DOUBLE"


@query("ood_override", _S + f"""SELECT row_id, CASE WHEN prob < 0.5996 AND {_OOD} < -0.5 THEN 'MODERATE (Unusual Pattern - OOD)' ELSE {_RISK} END
 AS "Risk_Level", prob < 0.5996 AND {_OOD} < -0.5 AS ood_warning FROM scored""")
def ood_override(spark, sf):
    rows = _scanned(spark, sf).withColumn("ood", -((F.col("row_id") * 37) % 100) / 100.0)
    return score.ood_override(rows, F.col("prob") >= THRESHOLD, "ood").select("row_id", "Risk_Level", "ood_warning")


@query("verdict_records", _PROBS + f"""SELECT row_id, CASE WHEN prob >= 0.5996 THEN 'MALICIOUS (THREAT DETECTED)' ELSE 'BENIGN (SAFE TRAFFIC)' END AS verdict,
 prob >= 0.5996 AS is_threat, CASE WHEN prob < 0.5996 THEN 'Benign' ELSE {_ARGMAX} END AS predicted_category, {_CONF} AS threat_confidence,
 round((1 - prob) * 100, 2) AS benign_confidence, CASE WHEN prob < 0.5996 AND {_OOD} < -0.5 THEN 'MODERATE (Unusual Pattern - OOD)' ELSE {_RISK} END
 AS risk_level, 0.5996::DOUBLE AS binary_threshold, round(1 - prob, 4) AS p_benign, round(prob, 4) AS p_malicious, round({_OOD}, 4) AS ood_score,
 prob < 0.5996 AND {_OOD} < -0.5 AS ood_warning FROM pr""")
def verdict_records(spark, sf):
    rows = _class_probs(spark, sf).withColumn("ood", -((F.col("row_id") * 37) % 100) / 100.0)
    out = score.verdict_records(rows, "prob", THRESHOLD, "ood", score.argmax_class(F.col("probs"), CLASSES), ["row_id"])
    return out.withColumns({
        "p_benign": F.col("class_probabilities")["BENIGN"], "p_malicious": F.col("class_probabilities")["MALICIOUS"],
    }).drop("class_probabilities")


_MULTI = ["BENIGN", "DDoS", "PortScan", "Botnet"]
_MARG = "['BENIGN', 'DDoS', 'PortScan', 'Botnet'][list_position(probs, list_max(probs))]"


@query("multiclass_collapse", _PROBS + f"""SELECT row_id, {_MARG} AS "Predicted_Category", CASE WHEN {_MARG} = 'BENIGN' THEN 'BENIGN' ELSE 'MALICIOUS' END
 AS "Predicted_Verdict", round(1 - probs[1], 6) AS threat_prob FROM pr""")
def multiclass_collapse(spark, sf):
    out = score.collapse_multiclass(_class_probs(spark, sf), "probs", _MULTI)
    return rounded(out.select("row_id", "Predicted_Category", "Predicted_Verdict", "threat_prob"))


@query("model_info", _S + """SELECT dataset, CASE WHEN dataset < '3' THEN 'Unknown' ELSE 'GBT' END AS binary_model_type, 'Unknown' AS training_date,
 CASE WHEN dataset < '2' THEN '1.0' ELSE '2.0' END AS schema_version, CASE WHEN dataset < '2' THEN 0.5::DOUBLE ELSE round(avg(prob), 3) END AS binary_threshold,
 count(*) AS n_rows FROM scored GROUP BY dataset""")
def model_info(spark, sf):
    path = scratch_path(spark, "metadata")
    known = view(spark, sf, "scored").groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("prob"), 3).alias("t")
    ).select(
        "dataset", "n_rows", F.when(F.col("dataset") >= "3", "GBT").alias("binary_model_type"),
        F.when(F.col("dataset") >= "2", "2.0").alias("schema_version"), F.when(F.col("dataset") >= "2", F.col("t")).alias("binary_threshold"))
    tables.write_json(known, path)
    return score.model_info(tables.scan_metadata(spark, path, known.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")))


# ---- metrics -----------------------------------------------------------------------------------

_CONFUSION = """count(*) FILTER (y_true = 1 AND prob >= 0.5996) AS tp, count(*) FILTER (y_true = 0 AND prob >= 0.5996) AS fp,
 count(*) FILTER (y_true = 1 AND prob < 0.5996) AS fn, count(*) FILTER (y_true = 0 AND prob < 0.5996) AS tn"""


def _r(num: str, den: str, name: str, scale: str = "") -> str:
    return f"round({scale}CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE 0 END, 6) AS {name}"


_RATES = ", ".join([
    "tp, fp, fn, tn, tp + fp + fn + tn AS total, tn + fp AS benign, tp + fn AS malicious", _r("tp + tn", "(tp + fp + fn + tn)", "accuracy"),
    _r("tp", "(tp + fp)", "precision"), _r("tp", "(tp + fn)", "recall"), _r("2 * tp", "(2 * tp + fp + fn)", "f1"),
    _r("tn", "(tn + fp)", "specificity"), _r("fp", "(tn + fp)", "fpr"), _r("fn", "(tp + fn)", "fnr"),
])


def _flagged(spark, sf):
    return view(spark, sf, "scored").withColumn("pred", (F.col("prob") >= THRESHOLD).cast("int"))


@query("confusion_matrix", _S + f"SELECT {_CONFUSION} FROM scored")
def confusion_matrix(spark, sf):
    return mx.confusion(_flagged(spark, sf), "y_true", "pred")


@query("binary_metrics", _S + f"SELECT {_RATES} FROM (SELECT {_CONFUSION} FROM scored)")
def binary_metrics(spark, sf):
    return rounded(mx.binary_metrics(_flagged(spark, sf), "y_true", "pred"))


@query("metrics_per_dataset", _S + f"SELECT dataset, {_RATES} FROM (SELECT dataset, {_CONFUSION} FROM scored GROUP BY dataset)")
def metrics_per_dataset(spark, sf):
    return rounded(mx.binary_metrics(_flagged(spark, sf), "y_true", "pred", ["dataset"]))


@query("metrics_per_family", _S + f"""SELECT specific_family, {_RATES} FROM (SELECT specific_family, {_CONFUSION} FROM scored
 WHERE specific_family IN ('F1', 'F3', 'F7') GROUP BY specific_family)""")
def metrics_per_family(spark, sf):
    listed = _flagged(spark, sf).where(F.col("specific_family").isin("F1", "F3", "F7"))
    return rounded(mx.binary_metrics(listed, "y_true", "pred", ["specific_family"]))


_CURVE = _S.rstrip() + """, s AS (SELECT prob AS threshold, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg FROM scored GROUP BY prob),
c AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM s) """


@query("roc_curve", _CURVE + "SELECT threshold, round(tp / np, 6) AS tpr, round(fp / nn, 6) AS fpr FROM c")
def roc_curve(spark, sf):
    return rounded(mx.roc_curve(view(spark, sf, "scored"), "y_true", "prob"))


@query("pr_curve", _CURVE + "SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / np, 6) AS recall FROM c")
def pr_curve(spark, sf):
    return rounded(mx.pr_curve(view(spark, sf, "scored"), "y_true", "prob"))


@query("roc_auc", _CURVE + "SELECT round(sum(neg * (tp - pos / 2.0)) / (max(np)::DOUBLE * max(nn)), 6) AS roc_auc FROM c")
def roc_auc(spark, sf):
    return rounded(mx.roc_auc(view(spark, sf, "scored"), "y_true", "prob"))


@query("average_precision", _CURVE + "SELECT round(sum(pos * (tp / (tp + fp))) / max(np), 6) AS average_precision FROM c")
def average_precision(spark, sf):
    return rounded(mx.average_precision(view(spark, sf, "scored"), "y_true", "prob"))


@query("curves_per_dataset", _S + """SELECT dataset, round(sum(neg * (tp - pos / 2.0)) / (max(np)::DOUBLE * max(nn)), 6) AS roc_auc,
 round(sum(pos * (tp / (tp + fp))) / max(np), 6) AS average_precision FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
 sum(pos) OVER (PARTITION BY dataset) AS np, sum(neg) OVER (PARTITION BY dataset) AS nn FROM (SELECT dataset, prob AS threshold,
 count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg FROM scored GROUP BY dataset, prob)
 WINDOW w AS (PARTITION BY dataset ORDER BY threshold DESC)) GROUP BY dataset""")
def curves_per_dataset(spark, sf):
    return rounded(mx.areas(view(spark, sf, "scored"), "y_true", "prob", ["dataset"]))


@query("curves_null_group", _S + """SELECT grp, round(sum(neg * (tp - pos / 2.0)) / (max(np)::DOUBLE * max(nn)), 6) AS roc_auc,
 round(sum(pos * (tp / (tp + fp))) / max(np), 6) AS average_precision FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
 sum(pos) OVER (PARTITION BY grp) AS np, sum(neg) OVER (PARTITION BY grp) AS nn FROM (SELECT grp, score AS threshold,
 count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg FROM (SELECT *, nullif(dataset, '1-URGENT') AS grp,
 CASE WHEN row_id % 7 <> 0 THEN prob / 4096 END AS score FROM scored) WHERE score IS NOT NULL GROUP BY grp, score)
 WINDOW w AS (PARTITION BY grp ORDER BY threshold DESC)) GROUP BY grp""")
def curves_null_group(spark, sf):
    """A null group, missing scores, and all scores in one narrow stretch."""
    rows = view(spark, sf, "scored").select(
        F.nullif("dataset", F.lit("1-URGENT")).alias("grp"), "y_true", F.when(F.col("row_id") % 7 != 0, F.col("prob") / 4096).alias("score"))
    return rounded(mx.areas(rows, "y_true", "score", ["grp"]))


_F1C = _CURVE.rstrip() + """, v AS (SELECT threshold, tp / np AS recall, fp / nn AS fpr,
 2 * (tp / (tp + fp)) * (tp / np) / (tp / (tp + fp) + tp / np + 1e-10::DOUBLE) AS f1 FROM c) """
_AT = "round(arg_min(f1, {'d': round(abs(threshold - t), 10), 't': threshold}), 6) AS f1_at_threshold"


@query("calibrate_f1", _F1C + f""", b AS (SELECT greatest(0.35, least(0.65, coalesce(
 (SELECT threshold FROM v WHERE recall >= 0.7 ORDER BY round(f1, 12) DESC, threshold LIMIT 1),
 (SELECT threshold FROM v ORDER BY round(f1, 12) DESC, threshold LIMIT 1), 0.5)))::DOUBLE AS t)
 SELECT 'f1' AS method, round(max(t), 6) AS threshold, {_AT} FROM v, b""")
def calibrate_f1(spark, sf):
    return rounded(mx.calibrate(view(spark, sf, "scored"), "y_true", "prob", "f1"))


@query("calibrate_recall_fpr", _F1C + f""", b AS (SELECT greatest(0.35, least(0.65, coalesce(
 (SELECT threshold FROM v WHERE recall >= 0.9 ORDER BY fpr, threshold DESC LIMIT 1), 0.5)))::DOUBLE AS t)
 SELECT 'recall_fpr' AS method, round(max(t), 6) AS threshold, {_AT} FROM v, b""")
def calibrate_recall_fpr(spark, sf):
    return rounded(mx.calibrate(view(spark, sf, "scored"), "y_true", "prob", "recall_fpr"))


@query("model_selection", _S + f""", m AS (SELECT model, {_RATES} FROM (SELECT model, count(*) FILTER (y_true = 1 AND p >= 0.5) AS tp,
 count(*) FILTER (y_true = 0 AND p >= 0.5) AS fp, count(*) FILTER (y_true = 1 AND p < 0.5) AS fn, count(*) FILTER (y_true = 0 AND p < 0.5) AS tn
 FROM (SELECT y_true, 'gbt' AS model, prob AS p FROM scored UNION ALL SELECT y_true, 'rf', round(prob * prob, 4) FROM scored) GROUP BY model))
 SELECT *, model = (SELECT model FROM m ORDER BY f1 DESC, model LIMIT 1) AS chosen FROM m""".replace(", m AS", "\n, m AS", 1))
def model_selection(spark, sf):
    rows = view(spark, sf, "scored").withColumn("rf", F.round(F.col("prob") * F.col("prob"), 4))
    return rounded(mx.better_model(rows, "y_true", {"gbt": "prob", "rf": "rf"}, "gbt"))


_GUESS = "['DoS', 'DDoS', 'PortScan', 'Botnet', 'Malware', 'Other'][CASE WHEN prob < 0.5 THEN 1 + row_id % 6 ELSE 1 + row_id % 5 END]"


@query("multiclass_f1", _S + f""", g AS (SELECT category AS y, {_GUESS} AS p FROM scored),
 t AS (SELECT y AS cls, count(*) AS support, count(*) FILTER (y = p) AS tp FROM g GROUP BY y), s AS (SELECT p AS cls, count(*) AS predicted FROM g GROUP BY p),
 u AS (SELECT coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted FROM t FULL JOIN s USING (cls)),
 w AS (SELECT *, 2.0::DOUBLE * tp / (support + predicted) AS f1 FROM u)
 SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM w""")
def multiclass_f1(spark, sf):
    names = F.array(*[F.lit(c) for c in ["DoS", "DDoS", "PortScan", "Botnet", "Malware", "Other"]])
    at = F.when(F.col("prob") < 0.5, F.col("row_id") % 6).otherwise(F.col("row_id") % 5).cast("int")
    return rounded(mx.multiclass_f1(view(spark, sf, "scored").withColumn("guess", names[at]), "category", "guess"))


@query("generalization_matrix", _S + "SELECT dataset, tp + fp + fn + tn AS flows, " + ", ".join([
    _r("tp + tn", "(tp + fp + fn + tn)", "accuracy_pct", "100 * "), _r("tp", "(tp + fp)", "precision_pct", "100 * "),
    _r("tp", "(tp + fn)", "recall_pct", "100 * "), _r("2 * tp", "(2 * tp + fp + fn)", "f1_pct", "100 * "),
    _r("tn", "(tn + fp)", "specificity_pct", "100 * "), _r("fp", "(tn + fp)", "fpr_pct", "100 * "), _r("fn", "(tp + fn)", "fnr_pct", "100 * "),
]) + f" FROM (SELECT dataset, {_CONFUSION} FROM scored GROUP BY dataset)")
def generalization_matrix(spark, sf):
    return rounded(mx.generalization(_flagged(spark, sf), "y_true", "pred", ["dataset"]))


_EXPECTED = "CASE WHEN y_true = 1 THEN 'malicious' ELSE 'benign' END"


@query("capture_report", _S + f"""SELECT capture_id, expected, flows, m AS malicious, flows - m AS benign, round(100.0::DOUBLE * m / flows, 6) AS malicious_pct,
 round(100.0::DOUBLE * (flows - m) / flows, 6) AS benign_pct, CASE WHEN expected = 'malicious' THEN round(100.0::DOUBLE * m / flows, 6) END AS detection_rate,
 CASE WHEN expected <> 'malicious' THEN round(100.0::DOUBLE * m / flows, 6) END AS false_positive_rate FROM (SELECT capture_id, {_EXPECTED} AS expected,
 count(*) AS flows, count(*) FILTER (prob >= 0.5996) AS m FROM scored GROUP BY ALL)""")
def capture_report(spark, sf):
    rows = _scanned(spark, sf).withColumn("expected", F.when(F.col("y_true") == 1, "malicious").otherwise("benign"))
    return rounded(reports.capture_report(rows, "capture_id", "Predicted_Verdict", "expected"))


@query("confidence_stats", _S + f"""SELECT capture_id, round(avg({_CONF}), 6) AS mean, round(median({_CONF}), 6) AS median, max({_CONF}) AS max,
 min({_CONF}) AS min FROM scored GROUP BY capture_id""")
def confidence_stats(spark, sf):
    return rounded(reports.confidence_stats(_scanned(spark, sf), "capture_id", "Threat_Confidence_%"))


@query("category_counts", _S + "SELECT category, count(*) AS flows FROM scored GROUP BY category")
def category_counts(spark, sf):
    return reports.category_counts(view(spark, sf, "scored"), "category")


@query("truth_join_metrics", _S + f"SELECT {_RATES} FROM (SELECT {_CONFUSION} FROM scored)")
def truth_join_metrics(spark, sf):
    rows = view(spark, sf, "scored")
    predicted = score.verdicts(rows.select("row_id", "prob"), "prob", THRESHOLD).select("row_id", "Predicted_Verdict")
    joined = rows.select("row_id", "y_true").join(predicted, "row_id")
    return rounded(mx.binary_metrics(joined.withColumn("pred", (F.col("Predicted_Verdict") == "MALICIOUS").cast("int")), "y_true", "pred"))


# ---- reports -----------------------------------------------------------------------------------


@query("scan_kpis", _S + """SELECT *, CASE WHEN threat_pct > 30 THEN 'CRITICAL' WHEN threat_pct > 0 THEN 'ELEVATED' ELSE 'NORMAL' END AS posture
 FROM (SELECT count(*) AS total, count(*) FILTER (prob >= 0.5996) AS threats, count(*) FILTER (prob < 0.5996) AS benign,
 round(100.0::DOUBLE * count(*) FILTER (prob >= 0.5996) / count(*), 6) AS threat_pct FROM scored)""")
def scan_kpis(spark, sf):
    return rounded(reports.scan_kpis(_scanned(spark, sf)))


def _scanned_flows(spark, sf):
    flows = fx.flow_table(view(spark, sf, "packets"), CFG, ["lengths"], False)
    prob = ((F.col("flow_start") * 7919) % 10007) / F.lit(10007.0)
    return score.verdicts(flows.withColumn("prob", prob), "prob", THRESHOLD)


_FLOWS = _flow_rows(_LENGTHS) + ", h AS (SELECT *, ((fst * 7919) % 10007) / 10007.0::DOUBLE AS prob, fwd_bytes + bwd_bytes AS total_bytes FROM g) "


@query("capture_kpis", _FLOWS + """SELECT capture_id, cast(sum(n) AS BIGINT) AS packets, count(*) AS flows, count(*) FILTER (prob >= 0.5996) AS threats,
 count(*) FILTER (prob < 0.5996) AS benign, round(sum(total_bytes) / 1024, 6) AS kilobytes FROM h GROUP BY capture_id""")
def capture_kpis(spark, sf):
    return rounded(reports.capture_kpis(_scanned_flows(spark, sf)))


@query("top_talkers", _FLOWS + """SELECT CASE proto WHEN 6 THEN 'TCP' ELSE 'UDP' END AS protocol, dport AS destination_port, count(*) AS flows,
 cast(sum(n) AS BIGINT) AS packets, cast(sum(total_bytes) AS BIGINT) AS bytes FROM h WHERE prob >= 0.5996 GROUP BY ALL
 ORDER BY packets DESC, protocol, destination_port LIMIT 10""")
def top_talkers(spark, sf):
    threats = reports.by_verdict(_scanned_flows(spark, sf), "threats")
    top = reports.top_talkers(threats, ["Protocol", "Destination_Port"], 10)
    return top.select(*[F.col(c).alias(c.lower()) for c in top.columns])


@query("filter_verdict", _S + "SELECT row_id, prob FROM scored WHERE prob < 0.5996")
def filter_verdict(spark, sf):
    return reports.by_verdict(_scanned(spark, sf), "benign").select("row_id", "prob")


@query("preview_projection", _S + f"""SELECT row_id, {_VERDICT} AS "Predicted_Verdict", {_CONF} AS "Threat_Confidence_%", {_RISK} AS "Risk_Level" FROM scored""")
def preview_projection(spark, sf):
    return reports.preview(_scanned(spark, sf), ["row_id"])


# ---- SQL-checkable parts of the models ---------------------------------------------------------


@query("standard_scale", """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS a, l_extendedprice AS b, cast(1 AS DOUBLE) AS c FROM lineitem)
 SELECT l_orderkey, l_linenumber, l_partkey, round((a - (SELECT avg(a) FROM s)) / (SELECT stddev_pop(a) FROM s), 6) + 0.0 AS a,
 round((b - (SELECT avg(b) FROM s)) / (SELECT stddev_pop(b) FROM s), 6) + 0.0 AS b, 0.0::DOUBLE AS c FROM s""")
def standard_scale(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"), F.lit(1.0).alias("c"))
    return rounded(models.scale(rows, models.fit_scaler(rows, ["a", "b", "c"])))


@query("label_index", _S + "SELECT row_id, category, dense_rank() OVER (ORDER BY category) - 1 AS label FROM scored")
def label_index(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "category")
    return models.encode_labels(rows, "category", models.label_codes(rows, "category"))


@query("known_class_filter", _S + """SELECT row_id, category FROM scored WHERE category IN (SELECT category FROM scored WHERE capture_id = 'cap1'
 AND category <> 'Botnet')""")
def known_class_filter(spark, sf):
    rows = view(spark, sf, "scored").select("row_id", "category", "capture_id")
    train = rows.where((F.col("capture_id") == "cap1") & (F.col("category") != "Botnet"))
    return models.known_classes(rows.select("row_id", "category"), train, "category")
