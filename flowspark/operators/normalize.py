"""Header normalization, schema checks and numeric cleaning of flow tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions.schema import (
    CONSTANT_COLUMNS, DOH_TO_FEATURE, FEATURES, FORBIDDEN, alias_table, canonical_name, feature_table,
    forbidden_table,
)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalize(df: DataFrame) -> DataFrame:
    """Canonical headers; of several columns with one canonical name the first is kept."""
    places = [f"c{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for place, name in zip(places, df.columns):
        first.setdefault(canonical_name(name), place)
    return df.toDF(*places).select(*[F.col(place).alias(name) for name, place in first.items()])


# ---- the same rules over a catalogue of headers: (dataset, ordinal, name) ----------------------


def canonical_headers(headers: DataFrame) -> DataFrame:
    trimmed = F.btrim("name", F.lit(" \t\n\r\x0b\x0c"))
    aliases = alias_table(headers.sparkSession).withColumnRenamed("canonical", "known")
    return headers.join(F.broadcast(aliases), F.lower(trimmed) == F.col("alias"), "left").select(
        "dataset", "ordinal", "name", F.coalesce("known", trimmed).alias("canonical"))


def rename_report(headers: DataFrame) -> DataFrame:
    return canonical_headers(headers).where(F.col("name") != F.col("canonical"))


def first_of_duplicates(headers: DataFrame) -> DataFrame:
    return canonical_headers(headers).groupBy("dataset", "canonical").agg(
        F.min("ordinal").alias("ordinal"), F.min_by("name", "ordinal").alias("name")
    )


def _names(headers: DataFrame) -> DataFrame:
    return canonical_headers(headers).select("dataset", "canonical").distinct()


def schema_present(headers: DataFrame) -> DataFrame:
    features = feature_table(headers.sparkSession).select("canonical")
    return _names(headers).join(F.broadcast(features), "canonical", "left_semi").select("dataset", "canonical")


def schema_missing(headers: DataFrame) -> DataFrame:
    wanted = F.array(*[F.lit(f) for f in FEATURES])
    # At most the 65 features are collected, however many headers a dataset has.
    known = F.when(F.col("canonical").isin(FEATURES), F.col("canonical"))
    have = canonical_headers(headers).groupBy("dataset").agg(F.collect_set(known).alias("have"))
    return have.select("dataset", F.explode(F.array_except(wanted, "have")).alias("canonical"))


def schema_extra(headers: DataFrame) -> DataFrame:
    features = feature_table(headers.sparkSession).select("canonical")
    return _names(headers).join(F.broadcast(features), "canonical", "left_anti").select("dataset", "canonical")


def schema_forbidden(headers: DataFrame) -> DataFrame:
    forbidden = forbidden_table(headers.sparkSession)
    return _names(headers).join(F.broadcast(forbidden), "canonical", "left_semi").select("dataset", "canonical")


def schema_verdict(headers: DataFrame) -> DataFrame:
    """Strict: nothing missing. Lenient: fewer than half of the features missing."""
    is_feature = F.col("canonical").isin(FEATURES)
    counted = _names(headers).groupBy("dataset").agg(
        F.count_if(is_feature).alias("present"),
        F.count_if(~is_feature).alias("extra"),
        F.count_if(F.col("canonical").isin(FORBIDDEN)).alias("forbidden"),
    )
    missing = F.lit(len(FEATURES)) - F.col("present")
    return counted.withColumn("missing", missing).withColumns({
        "strict_ok": missing == 0, "lenient_ok": missing < len(FEATURES) * 0.5,
    })


def check_schema(df: DataFrame, strict: bool = True) -> list[str]:
    """Missing features of one frame; raises before any job when they are too many."""
    have = {canonical_name(c) for c in df.columns}
    missing = [f for f in FEATURES if f not in have]
    if (strict and missing) or len(missing) >= len(FEATURES) * 0.5:
        raise ValueError(f"{len(missing)} of {len(FEATURES)} features are missing: {missing[:5]}")
    return missing


# ---- numeric content ---------------------------------------------------------------------------


def number(name: str) -> Column:
    return quoted(name).try_cast("double")


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def clean_number(value: Column) -> Column:
    return F.when(_finite(value), value).otherwise(F.lit(0.0))


def _per_column(df: DataFrame, columns: list[str], aggs: dict[str, callable]) -> DataFrame:
    """One row per column of `columns`, from one aggregation over the table."""
    one = df.agg(*[
        F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in aggs.items()]).alias(f"r{i}")
        for i, c in enumerate(columns)
    ])
    return one.select(F.inline(F.array(*[f"r{i}" for i in range(len(columns))])))


def non_numeric_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, columns, {
        "filled": lambda c: F.count(quoted(c)),
        "non_numeric": lambda c: F.count_if(quoted(c).isNotNull() & number(c).isNull()),
    })


def infinite_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, columns, {
        "infinite_rows": lambda c: F.count_if(F.abs(number(c)) == float("inf")),
    }).where(F.col("infinite_rows") > 0)


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, columns, {
        "low": lambda c: F.min(quoted(c).cast("string")), "high": lambda c: F.max(quoted(c).cast("string")),
    }).where(F.col("low").eqNullSafe(F.col("high")))


def feature_matrix(df: DataFrame, strict: bool = False, keep: list[str] = (), names: list[str] = FEATURES) -> DataFrame:
    """The 65 features (or `names`) in model order as finite doubles; absent or bad values are 0."""
    check_schema(df, strict) if strict else None
    df = normalize(df)
    have = set(df.columns)
    return df.select(*keep, *[
        (clean_number(number(f)) if f in have else F.lit(0.0)).alias(f) for f in names
    ])


def map_vector(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Feature vector from a map of strings; missing or bad values are 0."""
    vector = F.array(*[clean_number(F.try_element_at(F.col(column), F.lit(k)).try_cast("double")) for k in keys])
    return df.withColumn("vector", vector)


def drop_forbidden(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in FORBIDDEN])


def drop_constant(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in CONSTANT_COLUMNS or "bulk" in c.lower()])


def drop_invalid_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose `columns` are all finite numbers, those columns as doubles."""
    typed = df.withColumns({c: number(c) for c in columns})
    keep = F.lit(True)
    for c in columns:
        keep = keep & _finite(quoted(c))
    return typed.where(keep)


def doh_to_features(df: DataFrame) -> DataFrame:
    """DoH statistics as flow features: what has a counterpart is mapped, the rest is 0."""
    source = {feature: (col, factor) for col, (feature, factor) in DOH_TO_FEATURE.items() if col in df.columns}
    others = [c for c in df.columns if c not in DOH_TO_FEATURE]
    return df.select(*others, *[
        ((F.col(source[f][0]) * source[f][1]) if f in source else F.lit(0.0)).cast("double").alias(f)
        for f in FEATURES
    ])


def ordered(df: DataFrame, first: list[str]) -> DataFrame:
    """`first` and then the features present, in model order."""
    return df.select(*[quoted(c) for c in [*first, *[f for f in FEATURES if f in df.columns]]])


def fill_category(df: DataFrame, category: str | None, malicious: Column) -> DataFrame:
    if category is None or category not in df.columns:
        filled = F.when(malicious, "Unknown Malicious").otherwise("Benign")
    else:
        c = F.coalesce(F.col(category), F.lit("Unknown Malicious"))
        filled = F.when(c == "BENIGN", "Benign").otherwise(c)
    return df.withColumn("attack_category", filled)


def split_group(df: DataFrame, row_id: str) -> DataFrame:
    """Capture, else dataset, else the row itself: rows of one group stay in one split."""
    options = [c for c in ("capture_id", "dataset") if c in df.columns]
    return df.withColumn("split_group", F.coalesce(*[F.col(c).cast("string") for c in [*options, row_id]]))
