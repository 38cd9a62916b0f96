"""Training of the detector, the attack-family classifier and the anomaly detector on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

import json

from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.operators import isolation, metrics, sampling, score
from flowspark.operators.labels import binary_target
from flowspark.operators.normalize import feature_matrix, fill_category, split_group
from flowspark.session import materialize


@dataclass(frozen=True)
class TrainConfig:
    """Model sizes and split of a training run.

    `held_out` families never train. `capture_datasets` are split by whole captures where both classes have two at least
    (None: every dataset that allows it); the rest is split by rows. `fit_rows` bounds the rows the tree models are
    fitted on, per class (None: all): the nodes of deep forests are kept on the driver and grow with the rows. The
    anomaly model needs more than `anomaly_from` benign training rows.
    """

    rf_trees: int = 200
    rf_depth: int = 25
    rf_min_leaf: int = 5
    gbt_rounds: int = 300
    gbt_depth: int = 8
    gbt_step: float = 0.1
    test: float = 0.20
    val: float = 0.10
    threshold_method: str = "f1"
    isolation_trees: int = 100
    held_out: tuple[str, ...] = ()
    capture_datasets: tuple[str, ...] | None = ("USTC-TFC2016",)
    fit_rows: int | None = None
    anomaly_from: int = 100
    seed: int = 42


# ---- scaling and label encoding ----------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column, from one aggregation; a constant
    column is only centred."""
    row = df.agg(*[
        F.struct(F.avg(f"`{c}`").alias("m"), F.stddev_pop(f"`{c}`").alias("s")).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]).first()
    return {c: (row[i]["m"] or 0.0, row[i]["s"] or 1.0) for i, c in enumerate(columns)}


def _scaled(name: str, scaler: dict) -> Column:
    mean, std = scaler[name]
    return (F.col(f"`{name}`") - mean) / std


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: _scaled(c, scaler) for c in scaler})


def scaled_vector(scaler: dict[str, tuple[float, float]]) -> Column:
    return array_to_vector(F.array(*[_scaled(c, scaler) for c in scaler]))


def label_codes(df: DataFrame, label: str, out: str = "label") -> DataFrame:
    """(class, code): classes in sorted order from 0."""
    found = df.where(F.col(label).isNotNull()).select(label).distinct()
    return materialize(found.withColumn(out, F.dense_rank().over(Window.orderBy(label)) - 1), "classes")


def label_classes(df: DataFrame, label: str) -> list[str]:
    """Classes in sorted order for a classifier, which has a handful; more than a thousand are an error."""
    found = [r[0] for r in df.where(F.col(label).isNotNull()).select(label).distinct().orderBy(label).limit(1001).collect()]
    if len(found) > 1000:
        raise ValueError(f"column {label} has more than 1000 classes")
    return found


def encode_labels(df: DataFrame, label: str, classes: list[str] | DataFrame, out: str = "label") -> DataFrame:
    """Code of each row's class, null if unknown. Classes: names in order, or a table by label_codes (joined)."""
    if isinstance(classes, DataFrame):
        return df.join(classes, label, "left")
    codes = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])
    return df.withColumn(out, codes[F.col(label)])


def known_classes(df: DataFrame, train: DataFrame, label: str) -> DataFrame:
    return df.join(train.select(label).distinct(), label, "left_semi")


# ---- classifiers -------------------------------------------------------------------------------


def _balanced(df: DataFrame, label: str) -> DataFrame:
    """Weights that give every class the same total."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    weight = F.create_map(*[F.lit(float(x)) for k, n in counts.items() for x in (k, total / (len(counts) * n))])
    return df.withColumn("weight", weight[F.col(label).cast("double")])


def fit_forest(df: DataFrame, label: str, features: str, cfg: TrainConfig) -> RandomForestClassificationModel:
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, weightCol="weight", numTrees=cfg.rf_trees, maxDepth=cfg.rf_depth,
        minInstancesPerNode=cfg.rf_min_leaf, seed=cfg.seed,
    ).fit(_balanced(df, label))


def fit_boosted(df: DataFrame, label: str, features: str, cfg: TrainConfig) -> GBTClassificationModel:
    """Boosted trees; malicious rows weigh n_benign / n_malicious."""
    ratio = sampling.class_weight(df, label).first()["weight_ratio"]
    weighted = df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(1.0))
    return GBTClassifier(
        labelCol=label, featuresCol=features, weightCol="weight", maxIter=cfg.gbt_rounds, maxDepth=cfg.gbt_depth,
        stepSize=cfg.gbt_step, seed=cfg.seed,
    ).fit(weighted)


def probabilities(model, df: DataFrame, out: str) -> DataFrame:
    """Class probabilities of a model as an array column."""
    scored = model.transform(df)
    drop = [c for c in ("rawPrediction", "probability", "prediction") if c in scored.columns]
    return scored.withColumn(out, vector_to_array("probability")).drop(*drop)


def malicious_prob(model, df: DataFrame, out: str = "prob") -> DataFrame:
    return probabilities(model, df, "_p").withColumn(out, F.try_element_at("_p", F.lit(2))).drop("_p")


def importance(spark: SparkSession, model, names: list[str], top: int = 15) -> DataFrame:
    """Features by importance with their share in percent."""
    weights = model.featureImportances.toArray()
    total = float(weights.sum()) or 1.0
    rows = [(n, round(float(w), 6), 100.0 * float(w) / total) for n, w in zip(names, weights)]
    return (
        spark.createDataFrame(rows, "feature string, importance double, pct double")
        .orderBy(F.desc("importance"), "feature").limit(top)
    )


# ---- the detector ------------------------------------------------------------------------------


@dataclass
class Detector:
    """Everything needed to score flows: scaler, binary model, family model, anomaly trees."""

    scaler: dict[str, tuple[float, float]]
    model: object
    model_type: str
    threshold: float
    attack_model: object | None = None
    attack_classes: list[str] = field(default_factory=list)
    trees: DataFrame | None = None
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, strict: bool = False, ood: bool = False) -> DataFrame:
        """Scored flows, batch or stream: the input plus verdict, confidence, risk, category and score.

        `ood` raises the risk of benign flows with an unusual pattern.
        """
        rows = df.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        matrix = feature_matrix(rows, strict, keep=["_row"], names=list(self.scaler))
        out = matrix.select("_row", scaled_vector(self.scaler).alias("features"))
        out = score.verdicts(malicious_prob(self.model, out), "prob", self.threshold)
        threat = F.col("prob") >= self.threshold
        if self.attack_model is not None:
            out = probabilities(self.attack_model, out, "_attack")
            out = score.attack_category(out, threat, "_attack", self.attack_classes).drop("_attack", "category_confidence")
        else:
            out = out.withColumn("Predicted_Category", F.when(threat, "Unknown Malicious").otherwise("Benign"))
        if self.trees is not None:
            out = out.withColumn("OOD_Score", F.round(isolation.scorer(self.trees)(vector_to_array("features")), 4))
            if ood:
                out = score.ood_override(out, threat, "OOD_Score")
        extra = [c for c in out.columns if c not in ("_row", "features", "prob")]
        return out.select("_row.*", *[F.col(f"`{c}`") for c in extra])

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/binary")
        if self.attack_model is not None:
            self.attack_model.write().overwrite().save(f"{path}/attack")
        if self.trees is not None:
            self.trees.write.mode("overwrite").parquet(f"{path}/isolation")
        meta = {
            **self.info, "binary_model_type": self.model_type, "binary_threshold": self.threshold,
            "attack_classes": self.attack_classes, "features": list(self.scaler), "schema_version": "2.0",
            "means": [m for m, _ in self.scaler.values()], "stds": [s for _, s in self.scaler.values()],
            "has_anomaly_detector": self.trees is not None,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> Detector:
        spark = SparkSession.active()
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        kind = meta.get("binary_model_type", "GBT")
        loader = GBTClassificationModel if kind == "GBT" else RandomForestClassificationModel
        classes = meta.get("attack_classes", [])
        return cls(
            scaler=dict(zip(meta["features"], zip(meta["means"], meta["stds"]))), model=loader.load(f"{path}/binary"),
            model_type=kind, threshold=meta.get("binary_threshold", 0.5),
            attack_model=RandomForestClassificationModel.load(f"{path}/attack") if classes else None, attack_classes=classes,
            trees=spark.read.parquet(f"{path}/isolation") if meta.get("has_anomaly_detector") else None, info=meta,
        )


def fit_family(df: DataFrame, category: str, features: str, cfg: TrainConfig):
    """Family classifier on malicious rows only; (model, classes), or (None, []) without two classes."""
    rows = df.where(F.col(category) != "Benign")
    classes = label_classes(rows, category)
    if len(classes) < 2:
        return None, []
    encoded = encode_labels(rows, category, classes, "family_label").withColumn("family_label", F.col("family_label").cast("double"))
    return fit_forest(encoded, "family_label", features, cfg), classes


def training_table(df: DataFrame, row_id: str, strict: bool = False) -> DataFrame:
    """A labeled flow table as `train` takes it: the 65 features clean and in order, target, attack_category, split_group
    and the label columns; nothing that a model must not see is left among the features."""
    df = binary_target(df.withColumnRenamed("Binary_Label", "binary_label"))
    df = fill_category(df, "Attack_Category", F.col("target") == 1)
    df = split_group(df.withColumnsRenamed({"Capture_ID": "capture_id", "Dataset": "dataset"}), row_id)
    if "dataset" not in df.columns:
        df = df.withColumn("dataset", F.lit("Unknown"))
    keep = [c for c in (row_id, "dataset", "split_group", "Specific_Family", "target", "attack_category") if c in df.columns]
    return feature_matrix(df, strict, keep=keep)


def split_plan(df: DataFrame, row_id: str, dataset: str, group: str, target: str, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """`split` of every row: by whole captures in datasets that allow it, else by rows; classes alike in all splits."""
    allowed = sampling.capture_split_possible(df, dataset, group, target).where("by_capture").select(dataset)
    if cfg.capture_datasets is not None:
        allowed = allowed.where(F.col(dataset).isin(list(cfg.capture_datasets)))
    allowed = materialize(allowed.withColumnRenamed(dataset, "_d"), "by_capture")
    same = F.col(dataset).eqNullSafe(F.col("_d"))
    whole = sampling.capture_split(df.join(allowed, same, "left_semi"), dataset, group, target, cfg.test, cfg.val, cfg.seed)
    rows = sampling.stratified_split(df.join(allowed, same, "left_anti"), [dataset, target], cfg.test, cfg.val, cfg.seed, row_id)
    return whole.unionByName(rows)


def train(df: DataFrame, features: list[str], target: str, category: str, row_id: str, by: list[str],
          cfg: TrainConfig = TrainConfig(), group: str | None = None, family: str | None = None) -> tuple[Detector, DataFrame]:
    """Hold families out, split, fit both detectors, keep the better on validation, calibrate, fit family and anomaly models.

    `group` names the capture of a row; with it datasets (the first of `by`) are split as `split_plan` says. Returns the
    detector and the rows with their split ('held_out' for rows of held-out families), features scaled.
    """
    labels = list(dict.fromkeys([row_id, target, category, *by, *[c for c in (group, family) if c]]))
    df = materialize(df.select(*labels, *[F.col(f"`{c}`") for c in features]), "training")
    held = df.where(F.col(family).isin(list(cfg.held_out))) if family and cfg.held_out else df.limit(0)
    rest = df.where(~F.coalesce(F.col(family).isin(list(cfg.held_out)), F.lit(False))) if family and cfg.held_out else df
    split = split_plan(rest, row_id, by[0], group, target, cfg) if group else \
        sampling.stratified_split(rest, [*by, target], cfg.test, cfg.val, cfg.seed, row_id)
    split = materialize(split.unionByName(held.withColumn("split", F.lit("held_out"))), "split")
    scaler = fit_scaler(split.where("split = 'train'"), features)
    rows = materialize(split.select(*labels, "split", scaled_vector(scaler).alias("features")), "scaled")
    counts = {r[0]: r[1] for r in rows.groupBy("split").count().collect()}
    all_fit = rows.where("split = 'train'").withColumn(target, F.col(target).cast("double"))
    fit_rows = all_fit if cfg.fit_rows is None else sampling.cap_per_class(all_fit, [target], cfg.fit_rows, cfg.seed, row_id)
    forest, boosted = fit_forest(fit_rows, target, "features", cfg), fit_boosted(fit_rows, target, "features", cfg)
    both = materialize(malicious_prob(boosted, malicious_prob(forest, rows.where("split = 'val'"), "rf"), "gbt").select(target, "rf", "gbt"), "val")
    picked = metrics.better_model(both, target, {"GBT": "gbt", "RF": "rf"}, "GBT").where("chosen").first()["model"]
    threshold = metrics.calibrate(both, target, picked.lower(), cfg.threshold_method).first()["threshold"]
    attack_model, classes = fit_family(fit_rows.where(F.col(target) == 1), category, "features", cfg)
    calm = all_fit.where(F.col(target) == 0).select(row_id, vector_to_array("features").alias("x"))
    trees = isolation.fit(calm, row_id, "x", cfg.isolation_trees, cfg.seed) if calm.count() > cfg.anomaly_from else None
    info = {f"{name}_rows": counts.get(name, 0) for name in ("train", "val", "test", "held_out")}
    return Detector(scaler, boosted if picked == "GBT" else forest, picked, threshold, attack_model, classes, trees, info), rows


def run_metrics(detector: Detector, rows: DataFrame, target: str, category: str, dataset: str, family: str | None = None) -> DataFrame:
    """Metrics of a training run, one row each: the test rows, test rows per dataset, held-out rows per family."""
    scored = malicious_prob(detector.model, rows.where("split IN ('test', 'held_out')")) \
        .withColumn("_pred", (F.col("prob") >= detector.threshold).cast("int"))
    held = F.col("split") == "held_out"
    scopes = [F.struct(F.when(~held, "test").alias("scope"), F.lit("all").alias("name")),
              F.struct(F.when(~held, "dataset").alias("scope"), F.col(dataset).cast("string").alias("name"))]
    if family:
        scopes.append(F.struct(F.when(held, "held_out_family").alias("scope"), F.col(family).cast("string").alias("name")))
    long = materialize(scored.select(target, "prob", "_pred", F.explode(F.array(*scopes)).alias("s")).select(target, "prob", "_pred", "s.*")
                       .where("scope IS NOT NULL"), "scored")
    rates = metrics.binary_metrics(long, target, "_pred", ["scope", "name"])
    areas = metrics.areas(long, target, "prob", ["scope", "name"]).withColumnsRenamed({"scope": "_s", "name": "_n"})
    return rates.join(areas, rates["scope"].eqNullSafe(F.col("_s")) & rates["name"].eqNullSafe(F.col("_n")), "left").drop("_s", "_n")


def family_metrics(detector: Detector, rows: DataFrame, target: str, category: str) -> DataFrame | None:
    """Accuracy and F1 of the family classifier on malicious test rows of classes it knows; None without one."""
    if detector.attack_model is None:
        return None
    known = rows.where((F.col("split") == "test") & (F.col(target) == 1) & F.col(category).isin(detector.attack_classes))
    names = F.array(*[F.lit(c) for c in detector.attack_classes])
    said = probabilities(detector.attack_model, known, "_p").withColumn(
        "_said", F.element_at(names, F.array_position("_p", F.array_max("_p")).cast("int")))
    return metrics.multiclass_f1(said, category, "_said")
