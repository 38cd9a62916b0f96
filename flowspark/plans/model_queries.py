"""Models and streams (inventory section G, H7, H10, D14, D15).

What a model predicts has no SQL twin; its queries return, for every row, the facts that hold whatever was learned. Scores
of ensembles that SQL can build as well are in forest_queries.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.operators import features as fx
from flowspark.operators import flows as fl
from flowspark.operators import isolation, models
from flowspark.plans.flow_queries import _ALL_SQL, _K, CFG, assigned, rounded_features
from flowspark.plans.registry import query
from flowspark.plans.views import duck, view
from flowspark.session import materialize, scratch_path
from flowspark.streaming import flow_stream as fs

# Small models: the queries show the operators, not a tuned detector.
TRAIN = models.TrainConfig(rf_trees=6, rf_depth=5, gbt_rounds=3, gbt_depth=3, isolation_trees=25, anomaly_from=10)


def _vectors(spark, sf):
    rows = view(spark, sf, "feature_vectors")
    return rows.select(
        "row_id", "family", F.col("y_true").cast("double").alias("y_true"), "embedding",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


_ROWS = duck("feature_vectors")


def _facts(df, *keep, **facts):
    return df.select(*keep, *[F.coalesce(fact, F.lit(False)).alias(name) for name, fact in facts.items()])


def _separates(df, y, score):
    """Whether rows of class 1 score higher than the others on average, told to every row."""
    means = df.agg(F.avg(F.when(F.col(y) == 1, F.col(score))).alias("a"), F.avg(F.when(F.col(y) == 0, F.col(score))).alias("b"))
    return df.join(F.broadcast(means.select((F.col("a") > F.col("b")).alias("separates"))))


_PROBABLE = _ROWS + "SELECT row_id, y_true::DOUBLE AS y_true, TRUE AS in_range, TRUE AS separates FROM feature_vectors"


@query("model_rf_scores", _PROBABLE)
def model_rf_scores(spark, sf):
    rows = _vectors(spark, sf)
    scored = models.malicious_prob(models.fit_forest(rows, "y_true", "features", TRAIN), rows)
    return _facts(_separates(scored, "y_true", "prob"), "row_id", "y_true", in_range=F.col("prob").between(0, 1), separates=F.col("separates"))


@query("model_gbt_scores", _PROBABLE)
def model_gbt_scores(spark, sf):
    rows = _vectors(spark, sf)
    scored = models.malicious_prob(models.fit_boosted(rows, "y_true", "features", TRAIN), rows)
    return _facts(_separates(scored, "y_true", "prob"), "row_id", "y_true", in_range=F.col("prob").between(0, 1), separates=F.col("separates"))


@query("attack_classifier_scores", _ROWS + """SELECT row_id, concat('F', family) AS category, TRUE AS sums_to_one, TRUE AS known
 FROM feature_vectors WHERE y_true = 1""")
def attack_classifier_scores(spark, sf):
    rows = _vectors(spark, sf).withColumn(
        "category", F.when(F.col("y_true") == 1, F.concat(F.lit("F"), F.col("family").cast("string"))).otherwise("Benign"))
    model, classes = models.fit_family(rows, "category", "features", TRAIN)
    threats = models.probabilities(model, rows.where("y_true = 1"), "probs")
    names = F.array(*[F.lit(c) for c in classes])
    said = F.element_at(names, F.array_position("probs", F.array_max("probs")).cast("int"))
    total = F.aggregate("probs", F.lit(0.0), lambda a, p: a + p)
    present = rows.where("y_true = 1").select(F.col("category").alias("said")).distinct()
    threats = threats.withColumn("said", said).join(present.withColumn("known", F.lit(True)), "said", "left")
    return _facts(threats, "row_id", "category", sums_to_one=F.abs(total - 1) < 1e-6, known=F.col("known"))


@query("isolation_scores", _ROWS + "SELECT row_id, y_true::DOUBLE AS y_true, TRUE AS in_range FROM feature_vectors")
def isolation_scores(spark, sf):
    rows = _vectors(spark, sf)
    trees = isolation.fit(rows.where("y_true = 0"), "row_id", "embedding", TRAIN.isolation_trees, seed=TRAIN.seed)
    return _facts(rows.withColumn("s", isolation.scorer(trees)(F.col("embedding"))), "row_id", "y_true", in_range=F.col("s").between(-1, 0))


@query("feature_importance_top", "SELECT DISTINCT len(embedding) AS features, TRUE AS sums_to_one, TRUE AS in_range FROM embeddings")
def feature_importance_top(spark, sf):
    model = models.fit_forest(_vectors(spark, sf), "y_true", "features", TRAIN)
    table = models.importance(spark, model, [f"e{i}" for i in range(64)], 64)
    return _facts(table.agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total"), F.min("importance").alias("least")),
                  "features", sums_to_one=F.abs(F.col("total") - 1) < 1e-4, in_range=F.col("least") >= 0)


_STREAM_FEATURES = ["dur", "fwd_pkts", "bwd_pkts", "fwd_bytes", "bwd_bytes"]


def _labeled(flows):
    # Stand-in truth: flows whose answer outweighs the request.
    bad = F.col("bwd_bytes") > F.col("fwd_bytes")
    return flows.withColumns({
        "target": bad.cast("int"),
        "category": F.when(~bad, "Benign").when(F.col("fwd_pkts") > F.col("bwd_pkts"), "Slow").otherwise("Flood"),
    })


def _flows(spark, sf):
    flows = _labeled(fx.flow_table(view(spark, sf, "packets"), CFG, ["lengths"], False))
    return materialize(flows.withColumn("row_id", F.concat_ws("-", "capture_id", F.col("flow_start").cast("string"))), "flows")


_FLOWS = assigned() + f""" SELECT {_K}, flow_seq, min(pkt_no) AS flow_start FROM (SELECT p.*, f.flow_seq FROM p
 JOIN f USING (capture_id, pkt_no)) GROUP BY {_K}, flow_seq"""


def _consistent(scored, threshold):
    """Verdict, confidence, risk and category of a flow agree with each other."""
    bad, sure = F.col("Predicted_Verdict") == "MALICIOUS", F.col("`Threat_Confidence_%`")
    limit = 100 * threshold
    return (
        F.col("Predicted_Verdict").isin("MALICIOUS", "BENIGN") & sure.between(0, 100)
        & F.when(bad, sure >= limit - 0.01).otherwise(sure <= limit + 0.01)
        & (bad == (F.col("Predicted_Category") != "Benign")) & F.col("Risk_Level").isNotNull()
        & F.when(sure >= 85.01, F.col("Risk_Level").startswith("CRITICAL")).otherwise(True)
    )


@query("score_flows", f"SELECT capture_id, flow_start, TRUE AS consistent, TRUE AS in_range FROM ({_FLOWS})")
def score_flows(spark, sf):
    flows = _flows(spark, sf)
    detector, _ = models.train(flows, _STREAM_FEATURES, "target", "category", "row_id", ["capture_id"], TRAIN)
    path = scratch_path(spark, "detector")
    detector.save(path)
    loaded = models.Detector.load(path)
    return _facts(loaded.transform(flows, ood=True), "capture_id", "flow_start", consistent=_consistent(flows, loaded.threshold),
                  in_range=F.col("OOD_Score").between(-1, 0) & (F.col("ood_warning") | ~F.col("ood_warning")))


def _packet_stream(spark, sf):
    """The packets as a stream, closed by one far later packet that moves the watermark past every timeout."""
    packets = view(spark, sf, "packets")
    later = (F.max("ts_us") + 10 * CFG.active_us).alias("ts_us")
    fields = {"capture_id": F.lit("end"), "ts_us": F.col("ts_us"), "src_ip": F.lit("0"), "dst_ip": F.lit("0")}
    end = packets.agg(later).select(*[fields.get(c, F.lit(0)).cast(t).alias(c) for c, t in packets.dtypes])
    path = scratch_path(spark, "packets")
    packets.unionByName(end).write.parquet(path)
    return fs.open_stream(spark, path, spark.read.parquet(path).schema)


@query("stream_assign_flows", assigned() + f""" SELECT {_K}, flow_seq, min(pkt_no) AS flow_start, arg_min(ts_us, pkt_no) AS first_us,
 arg_max(ts_us, pkt_no) AS last_us, count(*) AS packets, cast(sum(payload_len) AS BIGINT) AS bytes
 FROM (SELECT p.*, f.flow_seq FROM p JOIN f USING (capture_id, pkt_no)) GROUP BY {_K}, flow_seq""")
def stream_assign_flows(spark, sf):
    flows = fs.numbered(fs.run_available(fs.stream_flows(_packet_stream(spark, sf), CFG), "flows"))
    return flows.where("capture_id <> 'end'").select(
        *fl.KEY, "flow_seq", "flow_start", "first_us", "last_us", (F.col("fwd_pkts") + F.col("bwd_pkts")).alias("packets"),
        (F.col("fwd_bytes") + F.col("bwd_bytes")).alias("bytes"))


@query("stream_flow_features_65", _ALL_SQL)
def stream_flow_features_65(spark, sf):
    """The features of flows as they end, from running state alone."""
    flows = fs.run_available(fs.stream_features(_packet_stream(spark, sf), CFG), "flows").where("capture_id <> 'end'")
    flows = fs.numbered(flows)
    return rounded_features(flows)


@query("stream_idle_sessions", assigned(active=None, rst=False, fin=False) + f""" SELECT {_K}, count(*) AS packets, cast(sum(payload_len) AS BIGINT) AS bytes,
 min(ts_us) AS first_us, max(ts_us) AS last_us FROM (SELECT p.*, f.flow_seq FROM p JOIN f USING (capture_id, pkt_no)) GROUP BY {_K}, flow_seq""")
def stream_idle_sessions(spark, sf):
    return fs.run_available(fs.stream_sessions(_packet_stream(spark, sf), CFG), "sessions").where("capture_id <> 'end'")


@query("stream_scores", f"SELECT capture_id, flow_seq, flow_start, TRUE AS consistent FROM ({_FLOWS})")
def stream_scores(spark, sf):
    """Flows scored as they end on all 65 features, by a forest fitted on the flows of the same packets at rest."""
    flows = materialize(_labeled(fx.flow_table(view(spark, sf, "packets"), CFG)), "flows")
    rest = fx.canonical(flows).join(flows.select("capture_id", "flow_start", "flow_seq", "target"), ["capture_id", "flow_start", "flow_seq"])
    scaler = models.fit_scaler(rest, FEATURES)
    rows = rest.select(F.col("target").cast("double").alias("target"), models.scaled_vector(scaler).alias("features"))
    detector = models.Detector(scaler, models.fit_forest(rows, "target", "features", TRAIN), "RF", 0.5)
    stream = fs.stream_features(_packet_stream(spark, sf), CFG).where("capture_id <> 'end'")
    scored = fs.numbered(fs.run_available(detector.transform(stream), "scores"))
    return _facts(scored, "capture_id", "flow_seq", "flow_start", consistent=_consistent(stream, 0.5))
