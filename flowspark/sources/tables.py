"""Readers and writers of flow tables: CSV, JSON and parquet."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_csv(spark: SparkSession, path: str, encoding: str = "utf-8", glob: str | None = None,
             columns: list[str] | None = None) -> DataFrame:
    """Flow CSV with a header; all columns as text, cast later where needed."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def is_utf8(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Per file whether its lines are valid UTF-8, to choose between utf-8 and latin-1."""
    lines = spark.read.option("pathGlobFilter", glob).text(path)  # bytes as they are
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8")
    )


def scan_csv_any(spark: SparkSession, path: str, glob: str = "*.csv", columns: list[str] | None = None) -> DataFrame:
    """CSV files of mixed encodings and headers: utf-8 where valid, latin-1 otherwise; columns meet by name.

    Only file names and headers come to the driver, which lists the files for any scan.
    """
    kinds = is_utf8(spark, path, glob)
    headers = file_headers(spark, path, glob).withColumnRenamed("path", "file")
    listed = kinds.join(headers, F.regexp_replace(kinds["file"], "^file:/+", "/") == F.regexp_replace(headers["file"], "^file:/+", "/")) \
        .groupBy("utf8", "header").agg(F.collect_list(kinds["file"]).alias("files")).orderBy("utf8", "header").collect()
    return _by_name([scan_csv(spark, sorted(r["files"]), "utf-8" if r["utf8"] else "iso-8859-1", columns=columns) for r in listed])


def _by_name(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


_C1 = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]


def from_cp1252(text: Column) -> Column:
    """Text that was read as latin-1 but is Windows-1252, which the CSV reader does not know."""
    known = [(latin, real) for latin, real in _C1 if real]
    return F.translate(text, "".join(a for a, _ in known), "".join(b for _, b in known))


def file_name() -> Column:
    return F.col("_metadata.file_name")


def folder_value(name: str) -> Column:
    """Value of a `name=value` folder in the file's path."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"{name}=([^/]+)/", 1)


def scan_dir(spark: SparkSession, path: str, glob: str = "*.csv", capture: Column | None = None,
             encoding: str = "utf-8") -> DataFrame:
    """All CSV files of one header under a folder (or one file), each row tagged with its file."""
    reader = spark.read.option("header", True).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    df = reader.option("encoding", encoding).csv(path)
    return df.select("*", (capture if capture is not None else file_name()).alias("capture_id"))


def file_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(path, header) of every file below a folder, or of one file: the first line alone is fetched, one task per few files."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path")
    tasks = max(1, min(found.count(), 10_000))

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name in pdf["path"]:
                system, local = fs.FileSystem.from_uri(name)
                with system.open_input_file(local) as f:
                    line = b""
                    while b"\n" not in line and (more := f.read(1 << 16)):
                        line += more
                rows.append((name, line.split(b"\n", 1)[0].rstrip(b"\r").removeprefix(b"\xef\xbb\xbf").decode("latin-1")))
            yield pd.DataFrame(rows, columns=["path", "header"])

    return found.repartition(tasks).mapInPandas(first_lines, "path string, header string")


def scan_by_header(spark: SparkSession, path: str, glob: str = "*.csv", encoding: str = "utf-8",
                   capture: Column | None = None) -> list[DataFrame]:
    """CSV files below a folder, one frame for each distinct header, each row tagged with its file.

    Spark reads the columns of one scan by position, so files whose columns differ in name or order may not share one.
    Only the listing of files and their headers comes to the driver.
    """
    groups = file_headers(spark, path, glob).where("header <> ''").groupBy("header").agg(F.collect_list("path").alias("paths"))
    frames = []
    for row in groups.orderBy("header").collect():
        df = spark.read.option("header", True).option("encoding", encoding).csv(sorted(row.paths))
        frames.append(df.select("*", (capture if capture is not None else file_name()).alias("capture_id")))
    return frames


def scan_parquet(spark: SparkSession, path: str, columns: list[str], where: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return (df.where(where) if where else df).select(*columns)


def scan_profiles(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """JSON flow profiles, one object per flow (one object per line, or a file each)."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("multiLine", False).json(path)


def scan_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, partition: str | None = None) -> None:
    """One table for all datasets, one folder per dataset."""
    writer = df.write
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_csv(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.option("header", True)
    (writer.partitionBy(partition) if partition else writer).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def as_json(df: DataFrame, keep: list[str]) -> DataFrame:
    """Each row as one JSON document next to its key columns."""
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias("json"))


def new_captures(found: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Captures not yet extracted with the same parameters."""
    return found.join(done.select(*keys).distinct(), keys, "left_anti")
