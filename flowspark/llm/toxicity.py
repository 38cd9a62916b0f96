"""Toxicity by a classifier chain: categories are predicted one after the other, each by a linear model that also sees the
probabilities of the categories before it. In fitting those are out-of-fold predictions, so a later model learns from
earlier ones as good as they are on unseen rows.

Inputs of the linear models are counts of telling terms (lower-cased words and word beginnings of 4 to 8 bytes, chosen by
a chi-square statistic over the labelled rows) and their share of the text. Fitting takes at most `MAX_ROWS` labelled
rows; scoring covers every whole text where it lies, without a shuffle.

The given tables label one category, toxic. `op3_toxicity` puts two narrower ones before it, derived from that label:
insult (toxic and naming one of the strongest quarter of the terms) and dense (toxic and at or above the median share of
terms among toxic rows).

Defined results: null and empty texts have no terms and are judged by the models' offsets alone, which call them clean
unless most labelled rows are toxic; null ids are kept; repeated rows score alike; without labels, or without both
classes, nothing is toxic (probability 0). An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.labelled import bounded_sample, named, one_each
from flowspark.llm.words import IS_LETTER, LOWER, mixed, slices, span_hashes, spans
from flowspark.session import materialize

MAX_ROWS = 12_000
TERMS = 200
LEAST_ROWS = 3
FOLDS = 4
PENALTY = 1.0
BEGINNINGS = (4, 5, 6, 7, 8)


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the accented letters of Latin-1; other bytes as they are."""
    low = LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.empty(0, np.int64)
    big = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    low[big] += 0x20
    return low


def terms(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, key) of every word and word beginning, and the number of words of each text."""
    low = lowered(data)
    first, last = spans(low, ends, IS_LETTER)
    cuts = np.searchsorted(first, ends)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(cuts))
    owners, keys = [owner], [span_hashes(low, first, last)]
    for size in BEGINNINGS:
        longer = last - first > size
        owners.append(owner[longer])
        keys.append(mixed(span_hashes(low, first[longer], first[longer] + size) + np.uint64(size)))
    return np.concatenate(owners), np.concatenate(keys), np.diff(cuts)


@dataclass
class Chain:
    """vocabulary: sorted keys. weights: per category over (terms, share, earlier logits, 1). cut: of the last category."""

    vocabulary: np.ndarray
    names: list[str]
    weights: list[np.ndarray] = field(default_factory=list)
    cut: float = 0.5

    def inputs(self, column: pa.Array) -> np.ndarray:
        k = len(self.vocabulary)
        parts = []
        for i, j, data, ends in slices(column):
            owner, key, words = terms(data, ends)
            at = np.minimum(np.searchsorted(self.vocabulary, key), max(k - 1, 0))
            hit = self.vocabulary[at] == key if k else np.zeros(len(key), bool)
            count = np.bincount(owner[hit] * k + at[hit], minlength=(j - i) * k).reshape(j - i, k).astype(np.float64)
            share = count.sum(1) / (words + 20)
            parts.append(np.concatenate([np.log1p(count), np.log1p(count.sum(1))[:, None], np.sqrt(share)[:, None]], 1))
        return np.concatenate(parts) if parts else np.empty((0, k + 2))

    def judge(self, column: pa.Array) -> np.ndarray:
        """Rows x categories of a column of texts, a few hundred rows at a time."""
        parts = [self.probabilities(self.inputs(column.slice(i, 512))) for i in range(0, len(column), 512)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.names)))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Rows x categories."""
        out = np.zeros((len(x), len(self.names)))
        for c, w in enumerate(self.weights):
            out[:, c] = _sigmoid(_with(x, out[:, :c]) @ w)
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _with(x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    p = np.clip(earlier, 0.001, 0.999)
    return np.concatenate([x, np.log(p / (1 - p)) / 4, np.ones((len(x), 1))], 1)


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Logistic regression by Newton steps; the last column is the offset and is not penalised."""
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(12):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit_chain(chain: Chain, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Chain:
    """Fit every category in order; y: rows x categories; fold: fold number of each row. Sets the last category's cut."""
    unseen = np.zeros(y.shape)
    for c in range(y.shape[1]):
        seen = _with(x, unseen[:, :c])
        for f in range(FOLDS):
            apart = fold == f
            if apart.any() and not apart.all():
                unseen[apart, c] = _sigmoid(seen[apart] @ fit_linear(seen[~apart], y[~apart, c]))
        chain.weights.append(fit_linear(seen, y[:, c]))
    chain.cut = best_cut(unseen[:, -1], y[:, -1])
    return chain


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """Cut with the best F1 on out-of-fold probabilities, in the middle of the gap it lies in."""
    order = np.argsort(-p, kind="stable")
    found = np.cumsum(y[order])
    f1 = 2 * found / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = 0
    best = int(f1.argmax())
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def vocabulary(rows: DataFrame, size: int = TERMS) -> np.ndarray:
    """Keys of the terms that tell label 1 best, strongest first. rows: text, label (0/1)."""
    @F.pandas_udf("array<long>")
    def keys(text: pd.Series) -> pd.Series:
        out = []
        for i, j, data, ends in slices(pa.array(text, pa.string())):
            owner, key, _ = terms(data, ends)
            out += [np.unique(key[owner == d]).view(np.int64) for d in range(j - i)]
        return pd.Series(out)

    n, n1 = (int(v or 0) for v in rows.agg(F.count(F.lit(1)), F.sum("label")).first())
    a, t = F.col("a"), F.col("t")
    chi = n * F.pow(a * (n - n1) - (t - a) * n1, 2) / F.greatest(F.lit(1.0), t * (n - t) * float(n1) * (n - n1))
    top = (
        rows.select("label", F.explode(keys("text")).alias("key")).groupBy("key")
        .agg(F.count(F.lit(1)).cast("double").alias("t"), F.sum("label").cast("double").alias("a"))
        .where((t >= LEAST_ROWS) & (a * n > t * n1)).orderBy(chi.desc(), "key").limit(size)
    )
    return np.array([r.key for r in top.collect()], np.int64).view(np.uint64)


def sample_of(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, label and fold of a bounded sample of labelled documents, one row for each id. labels: doc_id, label (0/1)."""
    usable = labels.where(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int").alias("label"))
    rows = one_each(named(docs.select("doc_id", "text"), bounded_sample(usable, max_rows)))
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), "label",
                       F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, size: int = TERMS) -> Chain:
    """The chain insult, dense, toxic from one toxicity label."""
    sample = materialize(sample_of(docs, labels, max_rows), "toxicity_sample")
    strongest = vocabulary(sample, size)
    chain = Chain(np.sort(strongest), ["insult", "dense", "toxic"])
    if not len(strongest):
        return chain

    @F.pandas_udf("array<double>")
    def inputs(text: pd.Series) -> pd.Series:
        return pd.Series(list(chain.inputs(pa.array(text, pa.string()))))

    got = sample.select("label", "fold", inputs("text").alias("x")).toPandas()
    x, toxic = np.array(got["x"].tolist(), float), got["label"].to_numpy(float)
    top = np.isin(chain.vocabulary, strongest[: max(1, len(strongest) // 4)])
    share = x[:, -1]
    insult = toxic * (x[:, : len(top)][:, top].sum(1) > 0)
    dense = toxic * (share >= (np.median(share[toxic == 1]) if toxic.any() else 0))
    return fit_chain(chain, x, np.stack([insult, dense, toxic], 1), got["fold"].to_numpy())


def with_toxicity(docs: DataFrame, chain: Chain, text_col: str = "text", out: str = "_toxicity") -> DataFrame:
    """docs with a struct of every category's probability and `rejected`."""
    names = chain.names
    kind = ", ".join(f"{n} double" for n in names) + ", rejected boolean"

    @F.pandas_udf(kind)
    def judged(text: pd.Series) -> pd.DataFrame:
        if not chain.weights:
            return pd.DataFrame({**{n: np.zeros(len(text)) for n in names}, "rejected": np.zeros(len(text), bool)})
        p = chain.judge(pa.array(text, pa.string()))
        return pd.DataFrame({**{n: p[:, c] for c, n in enumerate(names)}, "rejected": p[:, -1] >= chain.cut})

    return docs.withColumn(out, judged(F.col(f"`{text_col}`")))


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """docs without the rows the chain rejects; all columns as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return with_toxicity(rows, chain).where("NOT _toxicity.rejected").select("row.*")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    judged = with_toxicity(docs, learn(docs, labels))
    return judged.select("doc_id", *[F.col(f"_toxicity.{c}").alias(c) for c in ("insult", "dense", "toxic")],
                         F.col("_toxicity.rejected").alias("rejected"))
