"""Document quality by regularised quadratic discriminant analysis over document statistics.

Each text is reduced to a dozen statistics, transformed to be roughly bell-shaped. Per class a mean and a covariance are
estimated, the covariance shrunk towards the pooled one and towards a multiple of the identity; a score is the logistic
of the difference of the class log densities (Mahalanobis distances by cached Cholesky factors) and log priors. A
one-dimensional logistic fit on the training rows turns that difference into a probability.

Fitting takes at most `MAX_ROWS` labelled ids, one row each; scoring covers every whole text.

Defined results: null and empty texts have the statistics of no words and get a score like any other; null ids are not
held out; repeated rows score alike; with no labels, or one class only, every score is that class's share (0.5 without
labels). An empty table gives an empty table. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.labelled import bounded_sample, held_out, named, one_each
from flowspark.llm.words import IS_LETTER, slices, span_hashes, spans

MAX_ROWS = 30_000
SHRINK = 0.1
RIDGE = 0.02
#: Words of an ordinary text added to every text's shares.
PRIOR = 10
STATISTICS = ("words", "word_length", "capitals", "signs", "digits", "distinct", "stutter", "line_length", "repeated_lines",
              "shouted_words", "bare_bars", "marked_words", "repeated_pairs", "long_words")


def _per(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of values between the cuts."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[cuts[1:]] - total[cuts[:-1]]


def _per_span(flags: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1)
    np.cumsum(flags, out=total[1:])
    return total[last] - total[first]


def _distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys of each owner."""
    if not len(keys):
        return np.zeros(n)
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    return np.bincount(o[np.r_[True, (o[1:] != o[:-1]) | (k[1:] != k[:-1])]], minlength=n).astype(float)


def _slice_statistics(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(ends) - 1
    first, last = spans(data, ends)
    cuts = np.searchsorted(first, ends)
    owner = np.repeat(np.arange(n), np.diff(cuts))
    key = span_hashes(data, first, last)
    words, size = np.diff(cuts).astype(float), np.diff(ends).astype(float)
    some, chars = words + PRIOR, size + 6 * PRIOR  # a share counts for less in a short text
    upper = (data >= ord("A")) & (data <= ord("Z"))
    digit = (data >= ord("0")) & (data <= ord("9"))
    sign = ~IS_LETTER[data] & ~digit & (data > 32)
    caps, marked = _per_span(upper, first, last), _per_span(sign, first, last)
    length = (last - first).astype(float)
    same = np.r_[False, (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])] if len(key) else np.empty(0, bool)
    pair = key[:-1] * np.uint64(3) + key[1:] if len(key) > 1 else np.empty(0, np.uint64)
    joined = owner[:-1] == owner[1:]
    pairs = np.bincount(owner[:-1][joined], minlength=n) if len(pair) else np.zeros(n)
    line_at, line_to = spans(data, ends, _NOT_BREAK)
    line_owner = np.searchsorted(ends, line_at, "right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    line_key = span_hashes(data, line_at, line_to)
    return np.stack([
        np.log1p(words),
        np.log1p((_per(length, cuts) + 6 * PRIOR) / some),
        _root(_per(upper, ends) / chars),
        _root(_per(sign, ends) / chars),
        _root(_per(digit, ends) / chars),
        (_distinct(owner, key, n) + PRIOR) / some,
        _root(_per(same, cuts) / some),
        np.log1p(size / np.maximum(lines, 1)),
        _root((lines - _distinct(line_owner, line_key, n)) / (lines + 1)),
        _root(_per((caps >= 2) & (caps * 2 >= length - marked), cuts) / some),
        _root(_per((length == 1) & (marked == 1), cuts) / some),
        _root(_per(marked >= 2, cuts) / some),
        (pairs - _distinct(owner[:-1][joined], pair[joined], n)) / (pairs + PRIOR) if len(pair) else np.zeros(n),
        _root(_per(length > 20, cuts) / some),
    ], 1)


_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[[10, 13]] = False


def _root(share: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(share, 0))


def statistics(column: pa.Array) -> np.ndarray:
    """Rows x STATISTICS of a column of texts."""
    parts = [_slice_statistics(data, ends) for _, _, data, ends in slices(column)]
    return np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))


@dataclass
class Discriminant:
    """Two classes: means, Cholesky factors' inverses, log determinants, log priors; a, b: the logistic on top."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray
    a: float = 1.0
    b: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        logs = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(1) for m, w, c in zip(self.mean, self.whiten, self.constant, strict=True)]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.difference(x) + self.b, -500, 500)))


@dataclass
class Constant:
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def fit(x: np.ndarray, y: np.ndarray, shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant | Constant:
    if len(y) == 0 or min((y == 0).sum(), (y == 1).sum()) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    spread = np.maximum(x.std(0), 1e-6)
    groups = [x[y == c] for c in (0, 1)]
    covariances = [np.cov(g / spread, rowvar=False, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, covariances, strict=True)) / len(x)
    mean, whiten, constant = [], [], []
    for g, c in zip(groups, covariances, strict=True):
        weight = max(shrink, min(1.0, 5 * x.shape[1] / len(g)))  # small classes lean on the pooled covariance
        c = (1 - weight) * c + weight * pooled
        c = (1 - ridge) * c + ridge * max(np.trace(c) / len(c), 1e-3) * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        mean.append(g.mean(0))
        whiten.append(np.linalg.inv(factor) / spread)
        constant.append(np.log(len(g) / len(x)) - np.log(np.diag(factor)).sum())
    model = Discriminant(np.array(mean), np.array(whiten), np.array(constant))
    model.a, model.b = _logistic(np.clip(model.difference(x), -50, 50), y)
    return model


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (kept positive) and offset of a one-dimensional logistic fit, lightly held to (1, 0)."""
    design, w, prior = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        g = design.T @ (p - y) + (w - prior)
        h = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        w = w - np.linalg.solve(h, g)
    return max(float(w[0]), 1e-3), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Discriminant | Constant:
    """Fit on at most max_rows labelled rows that are not held out. docs: doc_id, text; labels: doc_id, label."""
    usable = labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "label")
    got = one_each(_statistics_of(named(docs.select("doc_id", "text"), bounded_sample(usable, max_rows)))).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(STATISTICS))
    return fit(x, got["label"].to_numpy(int))


def _statistics_of(rows: DataFrame) -> DataFrame:
    @F.pandas_udf("array<double>")
    def stats(text: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(pa.array(text, pa.string()))))

    return rows.select("doc_id", F.col("label").cast("int").alias("label"), stats("text").alias("x"))


def score(docs: DataFrame, model: Discriminant | Constant, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the score of every whole text; no shuffle."""
    @F.pandas_udf("double")
    def scores(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(statistics(pa.array(text, pa.string()))), index=text.index)

    return docs.withColumn(out, scores(F.col(f"`{text_col}`")))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
