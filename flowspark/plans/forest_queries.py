"""Ensembles as node tables over whole tables, with SQL that builds and scores the same trees (G2, G3, G5, G7, G8, H7, H10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowspark.operators import forest, score
from flowspark.operators import flows as fl
from flowspark.plans.flow_queries import _LENGTHS, CFG, _block_sql
from flowspark.plans.model_queries import _packet_stream, _vectors
from flowspark.plans.registry import query
from flowspark.plans.views import duck, view
from flowspark.session import materialize
from flowspark.streaming import flow_stream as fs

TREES, DEPTH, DIGITS = 8, 3, 9
FAMILIES = 10


def _trees_sql(source: str, key: str, keep: str, width: int) -> str:
    """CTEs of the forest by rule over `source` (key, keep, x): splits, then the node each row reaches on each level of each tree."""
    levels = [f"l0 AS (SELECT {key}, {keep}, x, t, 0 AS n0 FROM {source}, range({TREES}) r(t))"]
    for k in range(DEPTH):
        levels.append(
            f"l{k + 1} AS (SELECT l.*, 2 * n{k} + CASE WHEN x[f + 1] <= s THEN 1 ELSE 2 END AS n{k + 1} FROM l{k} l "
            f"JOIN sp ON f = (t * 7 + n{k} * 5) % {width})")
    split = f"sp AS (SELECT i - 1 AS f, round(avg(x[i]), 6) AS s FROM {source}, range(1, {width} + 1) r(i) GROUP BY i)"
    return ", ".join([split, *levels]) + f", lf AS (SELECT *, n{DEPTH} AS leaf FROM l{DEPTH})"


_ROWS = duck("feature_vectors") + ", fv AS (SELECT row_id, family, y_true, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM feature_vectors), "
_ROWS += _trees_sql("fv", "row_id", "family, y_true", 64)
_COUNTS = """, ct AS (SELECT t, leaf, count(*) AS n, count(*) FILTER (y_true = 0) AS c0, count(*) FILTER (y_true = 1) AS c1 FROM lf GROUP BY t, leaf)"""


def _binary(spark, sf):
    rows = _vectors(spark, sf)
    return rows, forest.by_rule(rows, "embedding", "y_true", 2, 64, TREES, DEPTH)


@query("forest_table_scores", _ROWS + _COUNTS + f"""
SELECT row_id, any_value(y_true)::DOUBLE AS y_true, round(avg(c1 / n), {DIGITS}) AS prob FROM lf JOIN ct USING (t, leaf) GROUP BY row_id""")
def forest_table_scores(spark, sf):
    rows, nodes = _binary(spark, sf)
    scored = forest.class_probabilities(rows, nodes, "embedding", DEPTH)
    return scored.select("row_id", "y_true", F.round(F.col("probs")[1], DIGITS).alias("prob"))


@query("boosted_table_scores", _ROWS + _COUNTS + f"""
SELECT row_id, round(1 / (1 + exp(-2 * sum(0.1 * ln((c1 + 1) / (c0 + 1)) / 2))), {DIGITS}) AS prob FROM lf JOIN ct USING (t, leaf) GROUP BY row_id""")
def boosted_table_scores(spark, sf):
    rows, nodes = _binary(spark, sf)
    scored = forest.boosted_probability(rows, forest.as_boosted(nodes), "embedding", DEPTH)
    return scored.select("row_id", F.round("prob", DIGITS).alias("prob"))


@query("family_table_scores", _ROWS + f""", ct AS (SELECT t, leaf, family, count(*) AS c FROM lf GROUP BY t, leaf, family),
nt AS (SELECT t, leaf, count(*) AS n FROM lf GROUP BY t, leaf),
ps AS (SELECT row_id, ct.family, round(sum(c / n) / {TREES}, {DIGITS}) AS p FROM lf JOIN ct USING (t, leaf) JOIN nt USING (t, leaf) GROUP BY row_id, ct.family)
SELECT row_id, arg_max('F' || family, (p, -family)) AS category, max(p) AS confidence FROM ps GROUP BY row_id""")
def family_table_scores(spark, sf):
    rows = _vectors(spark, sf)
    nodes = forest.by_rule(rows, "embedding", "family", FAMILIES, 64, TREES, DEPTH)
    scored = forest.class_probabilities(rows, nodes, "embedding", DEPTH).withColumn("probs", F.transform("probs", lambda p: F.round(p, DIGITS)))
    classes = [f"F{i}" for i in range(FAMILIES)]
    return scored.select("row_id", score.argmax_class(F.col("probs"), classes).alias("category"), F.array_max("probs").alias("confidence"))


_PATH = "CASE WHEN n > 2 THEN 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n WHEN n = 2 THEN 1.0 ELSE 0.0 END"


@query("isolation_table_scores", _ROWS + _COUNTS + f""", e AS (SELECT {_PATH} AS expected FROM (SELECT count(*) AS n FROM fv))
SELECT row_id, round(-pow(2.0, -avg({DEPTH} + {_PATH}) / any_value(expected)), {DIGITS}) AS score FROM lf JOIN ct USING (t, leaf), e GROUP BY row_id""")
def isolation_table_scores(spark, sf):
    rows, nodes = _binary(spark, sf)
    return forest.isolation_score(rows, nodes, "embedding", DEPTH).select("row_id", F.round("score", DIGITS).alias("score"))


_LEVEL = "SELECT t, n{k} AS node, count(*) AS n, count(*) FILTER (y_true = 0) AS c0, count(*) FILTER (y_true = 1) AS c1 FROM lf GROUP BY t, n{k}"


@query("importance_table", _ROWS + ", nd AS (" + " UNION ALL ".join(_LEVEL.format(k=k) for k in range(DEPTH + 1)) + f"""),
ms AS (SELECT t, node, n - (c0 * c0 + c1 * c1) / n AS mass FROM nd),
gn AS (SELECT a.t, (a.t * 7 + a.node * 5) % 64 AS f, a.mass - coalesce(b.mass, 0) - coalesce(c.mass, 0) AS gain
  FROM ms a LEFT JOIN ms b ON b.t = a.t AND b.node = 2 * a.node + 1 LEFT JOIN ms c ON c.t = a.t AND c.node = 2 * a.node + 2 WHERE a.node < {2**DEPTH - 1}),
al AS (SELECT t, sum(gain) AS total FROM gn GROUP BY t)
SELECT 'e' || f AS feature, round(sum(CASE WHEN total > 0 THEN gain / total / {TREES} ELSE 0 END), {DIGITS}) AS importance
FROM gn JOIN al USING (t) GROUP BY f""")
def importance_table(spark, sf):
    _, nodes = _binary(spark, sf)
    return forest.importances(nodes).select(
        F.concat(F.lit("e"), F.col("feature").cast("string")).alias("feature"), F.round("importance", DIGITS).alias("importance"))


_FLOW_FEATURES = ["dur", "fwd_pkts", "bwd_pkts", "fwd_bytes", "bwd_bytes"]
_RISKS = "CASE " + " ".join(f"WHEN p < {bound} THEN '{name}'" for bound, name in score.RISK_LEVELS) + f" ELSE '{score.RISK_TOP}' END"
_FLOWS_SQL = f"""WITH fr AS ({_block_sql(_FLOW_FEATURES, _LENGTHS)}),
fv AS (SELECT capture_id, flow_start, CASE WHEN bwd_bytes > fwd_bytes THEN 1 ELSE 0 END AS y_true,
  [{", ".join(f"{c}::DOUBLE" for c in _FLOW_FEATURES)}] AS x FROM fr), """ + _trees_sql("fv", "capture_id, flow_start", "y_true", 5) + _COUNTS + f""",
pr AS (SELECT capture_id, flow_start, round(avg(c1 / n), {DIGITS}) AS p FROM lf JOIN ct USING (t, leaf) GROUP BY capture_id, flow_start)
SELECT capture_id, flow_start, CASE WHEN p >= 0.5 THEN 'MALICIOUS' ELSE 'BENIGN' END AS verdict, round(p * 100, 2) AS confidence, {_RISKS} AS risk FROM pr"""


def _flow_rows(flows):
    flows = flows.withColumn("dur", F.greatest(F.lit(0), F.col("last_us") - F.col("first_us")).cast("double")) if "dur" not in flows.columns else flows
    return flows.select("capture_id", "flow_start", (F.col("bwd_bytes") > F.col("fwd_bytes")).cast("int").alias("y_true"),
                        F.array(*[F.round(F.col(c).cast("double"), 6) for c in _FLOW_FEATURES]).alias("x"))


def _scored(rows, nodes):
    rows = forest.class_probabilities(rows, nodes, "x", DEPTH).withColumn("p", F.round(F.col("probs")[1], DIGITS))
    return score.verdicts(rows, "p", 0.5).select("capture_id", "flow_start", F.col("Predicted_Verdict").alias("verdict"),
                                                 F.col("`Threat_Confidence_%`").alias("confidence"), F.col("Risk_Level").alias("risk"))


def _at_rest(spark, sf):
    from flowspark.operators import features as fx

    return materialize(_flow_rows(fx.flow_table(view(spark, sf, "packets"), CFG, ["lengths"], False)), "flows")


@query("score_flows_table", _FLOWS_SQL)
def score_flows_table(spark, sf):
    rows = _at_rest(spark, sf)
    return _scored(rows, forest.by_rule(rows, "x", "y_true", 2, len(_FLOW_FEATURES), TREES, DEPTH))


@query("stream_scores_table", _FLOWS_SQL)
def stream_scores_table(spark, sf):
    """Flows scored as they end, by a node table counted at rest."""
    nodes = forest.by_rule(_at_rest(spark, sf), "x", "y_true", 2, len(_FLOW_FEATURES), TREES, DEPTH)
    stream = fs.stream_flows(_packet_stream(spark, sf), CFG).where("capture_id <> 'end'")
    return fs.run_available(_scored(_flow_rows(stream), nodes), "table_scores")
