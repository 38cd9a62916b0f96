"""Isolation forest (Liu, Ting and Zhou, 2008): trees built and rows scored in parallel.

Each tree sees `PSI` rows picked by hash rank, so a tree is at most 2*PSI nodes whatever the data;
the forest is small enough to go to every task. The rows of all trees are the trees * PSI lowest
hashes of the whole table; with fewer rows the trees share them. A tree's depths count against the
expected depth of its own number of rows. Scores are negated: lower is more unusual.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.operators.sampling import keep_lowest, row_hash
from flowspark.session import materialize

PSI = 256
_NODES = "tree int, node int, feature int, split double, left_node int, right_node int, depth double, rows int"


def average_path(n):
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe, np.where(n == 2, 1.0, 0.0))


def _grow(seed: int):
    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf.sort_values("_h")["x"].to_numpy()).astype(float)
        rng = np.random.default_rng([seed, int(key[0])])
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        size = 1
        while todo:
            at, rows, depth = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth >= limit or len(rows) < 2 or not len(varied):
                nodes.append((key[0], at, -1, 0.0, -1, -1, depth + float(average_path(len(rows))), len(x)))
                continue
            f = int(rng.choice(varied))
            cut = float(rng.uniform(low[f], high[f]))
            below = x[rows, f] < cut
            nodes.append((key[0], at, f, cut, size, size + 1, 0.0, len(x)))
            todo += [(size, rows[below], depth + 1), (size + 1, rows[~below], depth + 1)]
            size += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "left_node", "right_node", "depth", "rows"])

    return grow


def fit(df: DataFrame, row_id: str, features: str, trees: int = 100, seed: int = 42) -> DataFrame | None:
    """Tree nodes; None without rows."""
    rows = df.select(row_id, F.col(features).alias("x")).withColumn("_all", F.lit(0))
    pool = materialize(keep_lowest(rows, ["_all"], F.lit(trees * PSI), seed, row_id), "pool")
    n = pool.count()
    if not n:
        return None
    ranked = pool.withColumn("_h", row_hash(seed, row_id)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_all").orderBy("_h", row_id)) - 1)  # at most trees * PSI rows
    spread = ranked.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    picked = spread.where(F.pmod(F.col("_rank") - F.col("tree") * PSI, F.lit(n)) < min(PSI, n))
    return materialize(picked.groupBy("tree").applyInPandas(_grow(seed), _NODES), "trees")


def scorer(trees: DataFrame) -> Callable[[Column], Column]:
    """Score of a feature array: -2^(-mean depth / expected depth)."""
    nodes = trees.toPandas().sort_values(["tree", "node"], ignore_index=True)  # at most 2*psi nodes a tree
    base = nodes.groupby("tree").size().cumsum().shift(fill_value=0)
    start = nodes["tree"].map(base).to_numpy()
    feature, split, depth = (nodes[c].to_numpy() for c in ("feature", "split", "depth"))
    left, right = nodes["left_node"].to_numpy() + start, nodes["right_node"].to_numpy() + start
    roots = base.to_numpy()
    levels = int(np.ceil(np.log2(PSI))) + 1
    norm = np.maximum(average_path(nodes["rows"].to_numpy()[roots]), 1.0)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()).astype(float)
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for root, expected in zip(roots, norm, strict=True):
                at = np.full(len(x), root)
                for _ in range(levels):
                    f = feature[at]
                    inner = f >= 0
                    below = x[rows, np.maximum(f, 0)] < split[at]
                    at = np.where(inner, np.where(below, left[at], right[at]), at)
                total += depth[at] / expected
            yield pd.Series(-np.exp2(-total / len(roots)))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")
