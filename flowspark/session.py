"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "flowspark", **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; the cluster's own settings win over none given here."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_dir: list[str] = []
_run = f"flowspark-{uuid.uuid4().hex[:12]}"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: spark.checkpoint.dir or the context's checkpoint folder.

    Without either a local session (tests) gets a temporary folder; on a cluster that would lose rows
    silently, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _fallback_dir:
        _fallback_dir.append(tempfile.mkdtemp(prefix="flowspark-"))
    return _fallback_dir[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below this process's own scratch folder."""
    return f"{shared_dir(spark)}/{_run}/{name}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Delete what this process has written as scratch; frames built on it can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{_run}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors and
    gives the planner true sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
