"""Sampling, balancing, splitting and combining of labeled tables.

Random order is the md5 of seed and row id, so that a sample does not depend on how the data is
partitioned. The n lowest hashes of a class are found without sorting the class: a histogram of
the leading 16 bits gives the bucket in which the n-th row lies, and only that bucket is ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import materialize

_DIGITS = 4  # leading hex digits of the hash: 65 536 buckets per class


def row_hash(seed: int | str, row_id: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_id).cast("string")))


def _bucketed(df: DataFrame, seed, row_id: str) -> DataFrame:
    return df.withColumn("_h", row_hash(seed, row_id)).withColumn("_b", F.substring("_h", 1, _DIGITS))


def _histogram(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each class up to and within each bucket: one row per class and bucket."""
    w = Window.partitionBy(*by).orderBy("_b")
    return (
        df.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(w))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*by)))
    )


def _cuts(hist: DataFrame, by: list[str], limits: dict[str, Column]) -> DataFrame:
    """Per class and limit the bucket that reaches it and how many of its rows still fit.

    One row per class, written out so that the planner knows its size when it picks the join.
    """
    def cut(limit: Column) -> Column:
        reach = (F.col("_upto") >= limit) & (F.col("_upto") - F.col("_n") < limit)
        return F.max(F.when(reach, F.struct(F.col("_b").alias("b"), (limit - F.col("_upto") + F.col("_n")).alias("left"))))

    found = hist.groupBy(*by).agg(*[cut(limit).alias(name) for name, limit in limits.items()])
    return materialize(found.select(
        *by, *[F.col(n)[f].alias(a) for n in limits for f, a in (("b", n), ("left", f"{n}_left"))]), "cuts")


def _with_cuts(rows: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """rows with their class's cuts; null is a class like any other."""
    named = cuts.withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & rows[c].eqNullSafe(named[f"_by{i}"])
    return rows.join(named, same, "left").drop(*[f"_by{i}" for i in range(len(by))])


def _keep_first(rows: DataFrame, by: list[str], limit: Column, order: list[str]) -> DataFrame:
    """The first `limit` rows of each class by bucket `_b`, then `order`; only the bucket the cut falls in is ranked.

    Equal rows are counted before they are ranked, however many there are: they are one row with a number, of which the
    cut takes as many as still fit.
    """
    cut = _cuts(_histogram(rows, by), by, {"_cut": limit})
    near = _with_cuts(rows, cut, by).where(limit > 0)
    clear = near.where(F.col("_cut").isNull() | (F.col("_b") < F.col("_cut")))  # no cut: the class is small
    names = near.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    edge = near.where(F.col("_b") == F.col("_cut")).groupBy(F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_same"), row.alias("_key")).agg(
        F.first(row).alias("_row"), F.count(F.lit(1)).alias("_times")).select("_row.*", "_same", "_times")
    before = Window.partitionBy(*by, "_b").orderBy(*order, "_same").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("_take", F.least(F.col("_times"), F.col("_cut_left") - F.coalesce(F.sum("_times").over(before), F.lit(0)))) \
        .where("_take > 0").withColumn("_one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take").cast("bigint")))).select(*names)
    return clear.unionByName(edge).drop("_h", "_b", "_cut", "_cut_left")


def keep_lowest(df: DataFrame, by: list[str], limit: Column, seed, row_id: str) -> DataFrame:
    """The `limit` rows of each class with the lowest hashes; `limit` may use columns of `by`."""
    return _keep_first(_bucketed(df, seed, row_id), by, limit, ["_h", row_id])


def first_packets(packets: DataFrame, n: int, bucket: int = 1 << 16) -> DataFrame:
    """The first n packets of each capture."""
    rows = packets.withColumn("_b", F.expr(f"pkt_no div {bucket}"))
    return _keep_first(rows, ["capture_id"], F.lit(n), ["pkt_no"])


def truncation(packets: DataFrame, n: int) -> DataFrame:
    """Per capture the packets taken under a cap of n and whether it cut the capture short."""
    return packets.groupBy("capture_id").agg(F.count(F.lit(1)).alias("frames")).select(
        "capture_id", F.least("frames", F.lit(n).cast("bigint")).alias("packets_processed"),
        (F.col("frames") > n).alias("was_truncated"),
    )


def cap_per_class(df: DataFrame, by: list[str], n: int, seed, row_id: str) -> DataFrame:
    return keep_lowest(df, by, F.lit(n), seed, row_id)


def two_level_cap(df: DataFrame, file: str, cls: str, per_file: int, benign: str, max_benign: int,
                  max_attack: int, seed, row_id: str) -> DataFrame:
    """At most `per_file` rows per file and class, then per class."""
    first = keep_lowest(df, [file, cls], F.lit(per_file), f"{seed}a", row_id)
    limit = F.when(F.col(cls) == benign, max_benign).otherwise(max_attack)
    return keep_lowest(first, [cls], limit, f"{seed}b", row_id)


def sample_n(df: DataFrame, n: int, seed, row_id: str) -> DataFrame:
    return df.orderBy(row_hash(seed, row_id), row_id).limit(n)


def quota_sample(df: DataFrame, cls: str, file: str, quotas: dict[str, int], benign: str, benign_n: int,
                 benign_per_file: int, seed, row_id: str) -> DataFrame:
    """Threat rows by quota and `benign_n` benign rows, at most `benign_per_file` of a file."""
    quota = F.element_at(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]), F.col(cls))
    threats = keep_lowest(df.where(F.col(cls).isin(list(quotas))), [cls], quota, seed, row_id)
    calm = keep_lowest(df.where(F.col(cls) == benign), [cls, file], F.lit(benign_per_file), f"{seed}a", row_id)
    calm = keep_lowest(calm, [cls], F.lit(benign_n), f"{seed}b", row_id)
    return threats.withColumn("expected_verdict", F.lit("THREAT")).unionByName(
        calm.withColumn("expected_verdict", F.lit("BENIGN"))
    )


def head_per_group(df: DataFrame, by: list[str], n: int, order: list[str]) -> DataFrame:
    """First n rows of each group. Each task keeps n rows per group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def shuffle_rows(df: DataFrame, seed, row_id: str) -> DataFrame:
    return df.orderBy(row_hash(seed, row_id), row_id)


def combine(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing from a frame is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def exclude(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Anti join on a short list given by the caller; rows without a value stay."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(values))


def hold_out(df: DataFrame, column: str, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose value is listed, all others)."""
    listed = materialize(listed.select(column).distinct(), "listed")
    return df.join(listed, column, "left_semi"), df.join(listed, column, "left_anti")


def stratified_split(df: DataFrame, by: list[str], test: float, val: float, seed, row_id: str) -> DataFrame:
    """`split` of every row: ceil(test*n) test rows of each class, then validation, then training."""
    rows = _bucketed(df, seed, row_id)
    hist = _histogram(rows, by)
    n_test = F.ceil(F.col("_total") * test)
    n_val = F.ceil((F.col("_total") - n_test) * (val / (1 - test)))
    rows = _with_cuts(rows, _cuts(hist, by, {"_t": n_test, "_v": n_test + n_val}), by)
    inner = (F.col("_b") == F.col("_t")) | (F.col("_b") == F.col("_v"))
    clear = rows.where(~F.coalesce(inner, F.lit(False))).withColumn("split", F.when(
        F.col("_b") < F.col("_t"), "test").when(F.col("_b") < F.col("_v"), "val").otherwise("train"))
    w = Window.partitionBy(*by, "_b").orderBy("_h", row_id)
    edge = rows.where(inner).withColumn("_rn", F.row_number().over(w)).withColumn("split", F.when(
        (F.col("_b") < F.col("_t")) | ((F.col("_b") == F.col("_t")) & (F.col("_rn") <= F.col("_t_left"))), "test"
    ).when(
        (F.col("_b") < F.col("_v")) | ((F.col("_b") == F.col("_v")) & (F.col("_rn") <= F.col("_v_left"))), "val"
    ).otherwise("train"))
    helpers = ["_h", "_b", "_t", "_t_left", "_v", "_v_left"]
    return clear.drop(*helpers).unionByName(edge.drop(*helpers, "_rn"))


def capture_split(df: DataFrame, dataset: str, capture: str, label: str, test: float, val: float, seed) -> DataFrame:
    """Whole captures of each class go to one split, ceil(test*n) captures to test. Null names a group like any other."""
    captures = df.select(dataset, capture, label).distinct()
    w = Window.partitionBy(dataset, label)
    ranked = captures.withColumns({
        "_rank": F.row_number().over(w.orderBy(row_hash(seed, capture), capture)),
        "_n": F.count(F.lit(1)).over(w),
    })
    n_test = F.ceil(F.col("_n") * test)
    n_val = F.ceil((F.col("_n") - n_test) * (val / (1 - test)))
    which = ranked.select(dataset, capture, label, F.when(F.col("_rank") <= n_test, "test").when(
        F.col("_rank") <= n_test + n_val, "val").otherwise("train").alias("split"))
    return _with_cuts(df, which, [dataset, capture, label])


def capture_split_possible(df: DataFrame, dataset: str, capture: str, label: str) -> DataFrame:
    """Per dataset whether each class has at least two captures."""
    per_class = df.groupBy(dataset, label).agg(F.countDistinct(capture).alias("n"))
    return per_class.groupBy(dataset).agg(((F.min("n") >= 2) & (F.count(F.lit(1)) == 2)).alias("by_capture"))


def leaking_captures(df: DataFrame, capture: list[str], split: str = "split") -> DataFrame:
    return df.groupBy(*capture).agg(F.countDistinct(split).alias("splits")).where(F.col("splits") > 1)


def class_weight(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(target) == 0).alias("n_benign"), F.count_if(F.col(target) == 1).alias("n_malicious")
    ).withColumn("weight_ratio", F.col("n_benign") / F.greatest("n_malicious", F.lit(1)))


def composition(df: DataFrame, dataset: str, label: str, category: str) -> DataFrame:
    """Counts by dataset, label and category with totals at each level."""
    return df.rollup(dataset, label, category).agg(F.count(F.lit(1)).alias("rows"))


def class_distribution(df: DataFrame, cls: str) -> DataFrame:
    counted = df.groupBy(cls).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct", 100.0 * F.col("rows") / total).orderBy(F.desc("rows"), cls)
