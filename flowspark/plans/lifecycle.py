"""From raw datasets to one training table, and from scored tables to metrics."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.functions.schema import METADATA
from flowspark.operators import features, labels, metrics, sampling
from flowspark.operators import normalize as nz
from flowspark.operators.flows import FlowConfig
from flowspark.session import materialize
from flowspark.sources import captures, tables

# Names of the datasets and of the DoH files.
CICIDS, USTC, DOH = "CICIDS2017", "USTC-TFC2016", "CIRA-CIC-DoHBrw-2020"
DOH_LEVEL1, DOH_LEVEL2 = "L1-DoH-NonDoH.parquet", "L2-BenignDoH-MaliciousDoH.parquet"

_LABEL_NAMES = {
    "capture_id": "Capture_ID", "original_label": "Original_Label", "binary_label": "Binary_Label",
    "attack_category": "Attack_Category", "attack_family": "Attack_Family", "specific_family": "Specific_Family",
    "is_encrypted": "Is_Encrypted",
}


def _capped(df: DataFrame, by: list[str], cap: int | None, seed: int) -> DataFrame:
    """At most `cap` rows per class. Rows have no id of their own; equal rows are interchangeable."""
    if not cap:
        return df
    rows = df.withColumn("_id", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return sampling.cap_per_class(rows, by, cap, seed, "_id").drop("_id")


def _labeled(df: DataFrame) -> DataFrame | None:
    """Rows of one header with canonical names, verdict and category; None if the files have no label."""
    df = df.toDF(*[c.strip() for c in df.columns]).withColumnRenamed("capture_id", "Capture_ID").withColumn("Dataset", F.lit(CICIDS))
    if "Attack_Category" in df.columns:
        return labels.passthrough_label(df.withColumn("Original_Label", F.col("Attack_Category")), "Attack_Category").withColumnsRenamed(_LABEL_NAMES)
    found = [c for c in df.columns if c.lower() == "label"]
    if not found:
        return None
    df = df.withColumn(found[0], tables.from_cp1252(F.col(found[0])))
    df = nz.normalize(df.withColumnRenamed(found[0], "Original_Label"))
    numeric = [c for c in df.columns if c not in METADATA]
    df = labels.exact_label(nz.drop_constant(nz.drop_invalid_rows(df, numeric)), "Original_Label")
    return df.withColumnsRenamed(_LABEL_NAMES)


def load_labeled_csv(spark: SparkSession, path: str, cap: int | None = None, seed: int = 42) -> DataFrame:
    """Labeled flow CSVs in Windows-1252: canonical headers, verdict and category, only rows of finite numbers.

    Files may differ in their columns and their order; labeled and prelabeled ones meet by name, those without a label
    are skipped. At most `cap` rows per label if given.
    """
    frames = [f for f in map(_labeled, tables.scan_by_header(spark, path, "*.csv", "iso-8859-1")) if f is not None]
    if not frames:
        raise ValueError(f"no label column in {path}")
    numbers = {c for f in frames for c, t in f.dtypes if t == "double"}
    frames = [f.withColumns({c: nz.number(c) for c in f.columns if c in numbers}) for f in frames]
    return _capped(sampling.combine(frames), ["Original_Label"], cap, seed)


def load_doh(spark: SparkSession, path: str, cap: int | None = None, seed: int = 42) -> DataFrame:
    """DoH statistics as flow features: benign HTTPS of level 1, everything of level 2; at most `cap` rows per class if given."""
    level1 = spark.read.parquet(f"{path}/{DOH_LEVEL1}").where(F.col("Label") == "NonDoH")
    level2 = spark.read.parquet(f"{path}/{DOH_LEVEL2}").withColumn("_bad", F.lower("Label") == "malicious")
    level1, level2 = _capped(level1, ["Label"], cap, seed), _capped(level2, ["_bad"], cap, seed).drop("_bad")
    out = nz.doh_to_features(labels.doh_labels(level1, level2))
    return out.withColumnsRenamed(_LABEL_NAMES).withColumn("Dataset", F.lit(DOH))


def _capture_flows(found: DataFrame, cfg: FlowConfig, max_packets: int | None, payload_basis: str) -> tuple[DataFrame, DataFrame]:
    """Flow features by path of all found captures, and what of them cannot be read."""
    read = captures.read_captures(found.sparkSession, found, max_packets, payload_basis)
    # Captures in different folders may share a file name, so flows are kept apart by path.
    packets = materialize(read.packets.withColumn("capture_id", F.col("path")).drop("path"), "packets")
    return features.flow_features(packets, cfg).withColumnRenamed("capture_id", "path"), read.bad


def _tagged(flows: DataFrame, found: DataFrame) -> DataFrame:
    tags = found.select("path", *[F.col(a).alias(b) for a, b in _LABEL_NAMES.items() if a in found.columns])
    return flows.join(tags, "path").drop("path").withColumn("Dataset", F.lit(USTC))


def load_capture_flows(spark: SparkSession, path: str, cfg: FlowConfig = FlowConfig(), done: DataFrame | None = None,
                       exclude: list[str] = (), max_packets: int | None = None, store: str | None = None,
                       payload_basis: str = "frame") -> DataFrame:
    """Labeled flow features of all captures under a folder that are not done yet.

    With a store, captures it holds for just these parameters are read from it, others are extracted and added first, and
    the flows of all of them come back.
    """
    found = captures.labeled_captures(spark, path, captures.config_key(cfg, max_packets, payload_basis), exclude)
    if done is not None:
        found = tables.new_captures(found, done, captures.LEDGER_KEY)
    if store is None:
        return _tagged(_capture_flows(found, cfg, max_packets, payload_basis)[0], found)
    return _tagged(CaptureStore(spark, store).through(found, lambda new: _capture_flows(new, cfg, max_packets, payload_basis)), found)


class CaptureStore:
    """Flows by capture and parameters, in batches that count once their manifest is written.

    A batch is flows/batch=<id> and, after them, one manifest file of the captures in it. Readers take batches the manifests
    name, so a run that stops before its manifest has written nothing that counts; the next run finds the same captures
    open, gets the same batch id from them, and writes the batch anew. Nothing is lost or there twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def manifest(self) -> DataFrame:
        """(path, config, batch) of every capture that is done."""
        path = f"{self.path}/manifest"
        kind = "path string, config string, batch string"
        return self.spark.read.schema(kind).parquet(path) if self._exists(path) else self.spark.createDataFrame([], kind)

    def bad(self) -> DataFrame:
        """(path, bad_at, reason, batch) of captures that could not be read, or not to their end."""
        path = f"{self.path}/bad"
        kind = "path string, bad_at bigint, reason string, batch string"
        return self.spark.read.schema(kind).parquet(path) if self._exists(path) else self.spark.createDataFrame([], kind)

    def flows(self, found: DataFrame) -> DataFrame:
        """Flows of found captures (path, config) as far as they are done."""
        have = materialize(self.manifest().join(found.select("path", "config").distinct(), captures.LEDGER_KEY), "have")
        names = [r.batch for r in have.select("batch").distinct().collect()]  # one for each run that added captures
        if not names:
            return None
        read = self.spark.read.option("basePath", f"{self.path}/flows").parquet(*[f"{self.path}/flows/batch={n}" for n in names])
        return read.join(have.select("path", "batch"), ["path", "batch"]).drop("batch")

    def through(self, found: DataFrame, extract) -> DataFrame:
        """Flows of found captures, those not done yet extracted and kept. extract(captures) gives flows and bad captures."""
        new = materialize(tables.new_captures(found, self.manifest(), captures.LEDGER_KEY), "new_captures")
        if not new.isEmpty():
            self.add(new, *extract(new))
        flows = self.flows(found)
        return flows if flows is not None else extract(found.limit(0))[0]

    def add(self, new: DataFrame, flows: DataFrame, bad: DataFrame) -> None:
        """Keep the flows of new captures: flows, then what is bad, then the manifest, one file that appears at once."""
        what = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "config").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("config", "path"))).first()
        batch = hashlib.sha256(repr(tuple(map(str, what))).encode()).hexdigest()[:24]
        flows.write.mode("overwrite").parquet(f"{self.path}/flows/batch={batch}")
        bad = materialize(bad, "bad")
        bad.write.mode("overwrite").parquet(f"{self.path}/bad/batch={batch}")
        # What cannot be read at all is tried again next time.
        unread = bad.where("bad_at = 0").select("path")
        done = new.select("path", "config").distinct().join(unread, "path", "left_anti")
        done.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch}")


def prepare(frames: list[DataFrame], path: str) -> DataFrame:
    """All datasets as one table, one folder per dataset."""
    tables.write_parquet(sampling.combine(frames), path, "Dataset")
    return frames[0].sparkSession.read.parquet(path)


def evaluate(scored: DataFrame, by: list[str] = (), listed: dict[str, list[str]] | None = None) -> DataFrame:
    """All metrics of scored rows per group; `listed` keeps only the named values of a column.

    The truth is the first truth column present; areas use the two-decimal confidence.
    """
    rows = scored.withColumns({
        "_y": labels.truth_target(scored), "_pred": (F.col("Predicted_Verdict") == "MALICIOUS").cast("int"),
        "_prob": F.col("`Threat_Confidence_%`") / 100,
    })
    for column, keep in (listed or {}).items():
        rows = rows.where(F.col(column).isin(keep))
    by = list(by)
    if not by:
        rows, by = rows.withColumn("group", F.lit("all")), ["group"]
    rates = metrics.binary_metrics(rows, "_y", "_pred", by)
    areas = metrics.areas(rows, "_y", "_prob", by).withColumnsRenamed({c: f"_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & rates[c].eqNullSafe(areas[f"_{c}"])
    return rates.join(areas, same, "left").drop(*[f"_{c}" for c in by])
