"""Labels: verdict, category and family of a row from raw labels, paths and truth columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions.schema import (
    BENIGN_VALUES, LABEL_FRAGMENTS, TRUTH_COLUMNS, exact_label_table, label_catalog,
)


def exact_label(df: DataFrame, raw: str) -> DataFrame:
    """Looked up exactly, then by 'Web Attack' or any-case benign, else an other attack."""
    lookup = F.broadcast(exact_label_table(df.sparkSession).withColumnRenamed("raw", "_raw"))
    label = F.trim(raw)
    benign = F.lower(label) == "benign"
    web = label.contains("Web Attack")
    return df.join(lookup, label == F.col("_raw"), "left").withColumns({
        "binary_label": F.coalesce("verdict", F.when(~web & benign, "BENIGN").otherwise("MALICIOUS")),
        "attack_category": F.coalesce(
            "category", F.when(web, "Web Attack").when(benign, "Benign").otherwise("Other Attack")),
    }).drop("_raw", "verdict", "category")


def substring_label(raw: Column) -> Column:
    """Category from label fragments in order of precedence, case-sensitive, ASCII only."""
    cleaned = F.regexp_replace(F.trim(raw), r"[^\x00-\x7F]", "")
    out = F.when(cleaned == "BENIGN", "BENIGN")
    for fragment, category in LABEL_FRAGMENTS:
        out = out.when(cleaned.contains(fragment), category)
    return out.otherwise("Other Attack")


def passthrough_label(df: DataFrame, category: str) -> DataFrame:
    """Already labeled rows: BENIGN in any case is benign."""
    c = F.trim(category)
    benign = F.upper(c) == "BENIGN"
    return df.withColumns({
        "binary_label": F.when(benign, "BENIGN").otherwise("MALICIOUS"),
        "attack_category": F.when(benign, "Benign").otherwise(c),
    })


def path_labels(df: DataFrame, path: str = "path") -> DataFrame:
    """Class folder and family from capture paths; files that are not captures are left out."""
    p = F.col(path)
    inside = F.regexp_extract(p, r"/(?:Benign|Malware)/(.*)$", 1)
    folder = F.regexp_extract(inside, r"^(.*)/[^/]*$", 1)
    file_name = F.element_at(F.split(p, "/"), -1)
    family = F.when(folder != "", folder).otherwise(F.split(file_name, r"\.").getItem(0))
    malware = F.regexp_extract(p, r"/(Benign|Malware)/", 1) == "Malware"
    return df.where(p.rlike(r"/(Benign|Malware)/.*\.(pcap|pcapng)$")).withColumns({
        "capture_id": file_name,
        "original_label": family,
        "binary_label": F.when(malware, "MALICIOUS").otherwise("BENIGN"),
        "attack_category": F.when(malware, "Malware").otherwise("Benign"),
        "attack_family": F.when(malware, "Malware").otherwise("Benign"),
        "specific_family": family,
    })


def doh_labels(level1: DataFrame, level2: DataFrame, label: str = "Label") -> DataFrame:
    """Benign HTTPS rows of level 1 and all rows of level 2."""
    both = level1.where(F.col(label) == "NonDoH").unionByName(level2)
    malicious = F.lower(label) == "malicious"
    return both.withColumns({
        "original_label": F.col(label),
        "binary_label": F.when(malicious, "MALICIOUS").otherwise("BENIGN"),
        "attack_category": F.when(malicious, "Encrypted Tunnel").otherwise("Benign"),
        "is_encrypted": F.lit(True),
    }).drop(label)


def binary_target(df: DataFrame, label: str = "binary_label") -> DataFrame:
    if label not in df.columns:
        raise ValueError(f"column {label} with BENIGN or MALICIOUS is required")
    return df.withColumn("target", (F.col(label) == "MALICIOUS").cast("int"))


def truth_target(df: DataFrame) -> Column:
    """1 for malicious, from the first truth column present. Names are compared as text; `Is_Malicious` may be boolean, a
    number (cut to an integer) or text holding one. A missing name is malicious, but a missing `Binary_Label` or
    `Is_Malicious` is not."""
    types = dict(df.dtypes)
    for name, benign in (("Binary_Label", None), ("Expected_Verdict", "BENIGN"), ("Is_Malicious", None), ("Label", "BENIGN"), ("label", "BENIGN")):
        if name not in df.columns:
            continue
        value = F.col(name)
        if name == "Is_Malicious":
            number = value.cast("int") if types[name] == "boolean" else value.try_cast("double").try_cast("int")
            bad = number == 1
        else:
            text = F.upper(value.cast("string"))
            bad = text == "MALICIOUS" if benign is None else text.isNull() | (text != benign)
        return F.when(bad, 1).otherwise(0)
    raise ValueError("no truth column found")


def benign_by_values(column: str, benign_value: str | None = None) -> Column:
    """BENIGN for a known benign value or `benign_value`; anything else, null too, is MALICIOUS."""
    text = F.trim(F.col(column).cast("string"))
    benign = F.upper(text).isin(sorted({v.upper() for v in BENIGN_VALUES}))
    if benign_value is not None:
        benign = benign | (text == benign_value)
    return F.when(benign, "BENIGN").otherwise("MALICIOUS")


def truth_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in TRUTH_COLUMNS]


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct()
        .orderBy("value")
    )


def join_catalog(df: DataFrame, dataset: Column, raw: str) -> DataFrame:
    """Declared verdict, family and category of each (dataset, raw label)."""
    catalog = F.broadcast(label_catalog(df.sparkSession).withColumnsRenamed({"dataset": "_d", "raw": "_r"}))
    on = (dataset == F.col("_d")) & (F.trim(raw) == F.col("_r"))
    return df.join(catalog, on, "left").drop("_d", "_r")
