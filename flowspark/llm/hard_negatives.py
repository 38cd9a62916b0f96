"""Hard negatives by exact integer scores: a residue-number-system GEMM, then windowed selection.

Components become whole numbers. Their matrices are multiplied modulo several small primes: balanced residues are so
small that a float32 product over 64 components is exact, and wider vectors are multiplied in runs of 64. As many primes
are taken as the largest possible score needs, and the signed score comes back exactly by Chinese remaindering (balanced
mixed radix digits).

Anchors are a stated query set, held against all rows in blocks of bounded size; every block reads the written rows
twice (positives first, since they set the windows of the negatives) and moves only each task's best rows of each anchor.
No row is left out, whatever its scores.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part. Vectors of
unequal length are filled up with zeros; an empty one scores 0 with all. A row with a null id is never an anchor, comes
after all ids among ties and is returned with a null id. Repeated rows are rows of their own: each is another row to its
twin. An empty table gives an empty table. Other columns are ignored. Components whose scores could pass 2**62 are an
error, since such a score fits no long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import materialize

#: Balanced residues are at most 510, and 64 products of them stay below 2**24, exact in float32.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
RUN = 64
SCALE = 256
#: Bytes of one block of anchors (64-bit components), sent to all executors.
BLOCK_BYTES = 16 << 20
#: Scores worked out at once inside a task: anchors by rows.
TILE = (512, 2048)
NEVER = -(1 << 63)

BEST = "query long, score long, id long, rid long"


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p in -(p-1)/2 .. (p-1)/2; x: doubles that hold whole numbers."""
    return x - p * np.rint(x / p)


class Residues:
    """Exact products of whole-number matrices whose entries stay within a bound."""

    def __init__(self, bound: int):
        """bound: no score is larger in size."""
        self.primes, self.weights, product = [], [], 1
        for p in PRIMES:
            if self.primes and product > 2 * bound:
                break
            self.primes.append(p)
            self.weights.append(product)
            product *= p
        if product <= 2 * bound:
            raise ValueError("scores need more primes than there are")

    def of(self, rows: np.ndarray) -> list[np.ndarray]:
        """Balanced float32 residues of int64 rows, one matrix for each prime."""
        return [((rows + p // 2) % p - p // 2).astype(np.float32) for p in self.primes]

    def products(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """int64 scores of every row of a with every row of b."""
        digits: list[np.ndarray] = []
        total = np.zeros((len(a[0]), len(b[0])), np.int64)
        for i, p in enumerate(self.primes):
            left = np.zeros(total.shape)
            for k in range(0, a[i].shape[1], RUN):
                left = balanced(left + (a[i][:, k:k + RUN] @ b[i][:, k:k + RUN].T).astype(np.float64), p)
            # the next mixed radix digit: what the digits before leave open modulo p
            for digit, weight in zip(digits, self.weights, strict=False):
                left = balanced(left - digit * float((weight % p + p // 2) % p - p // 2), p)
            digit = balanced(left * float(pow(self.weights[i], -1, p)), p)
            digits.append(digit)
            total += digit.astype(np.int64) * np.int64(self.weights[i])
        return total


class Best:
    """The first `size` rows of each query so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, queries: int, size: int):
        self.size, self.floor = size, np.full(queries, NEVER)
        self.query, self.score, self.id, self.none, self.rid = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64))

    def add(self, scores: np.ndarray, able: np.ndarray, queries: np.ndarray, ids: np.ndarray, none: np.ndarray, rids: np.ndarray) -> None:
        """scores (queries by rows) of rows in the order of their ids; able: which of them may be taken."""
        able = able & (scores >= self.floor[queries][:, None])
        if not able.any():
            return
        if able.sum() > 4 * self.size * len(queries) and scores.shape[1] > self.size:
            held = np.where(able, scores, NEVER)
            least = np.partition(held, -self.size, axis=1)[:, -self.size][:, None]
            above = held > least
            level = (held == least) & able
            room = self.size - above.sum(1, keepdims=True)
            able = above | (level & (np.cumsum(level, axis=1) <= room))
        q, r = np.nonzero(able)
        self.query, self.score = np.concatenate([self.query, queries[q]]), np.concatenate([self.score, scores[q, r]])
        self.id, self.none, self.rid = (np.concatenate([old, new[r]]) for old, new in ((self.id, ids), (self.none, none), (self.rid, rids)))
        order = np.lexsort((self.rid, self.id, self.none, -self.score, self.query))
        query = self.query[order]
        first = np.searchsorted(query, query, "left")
        order = order[np.arange(len(order)) - first < self.size]
        self.query, self.score, self.id, self.none, self.rid = (x[order] for x in (self.query, self.score, self.id, self.none, self.rid))
        full = np.flatnonzero(np.bincount(self.query, minlength=len(self.floor)) == self.size)
        self.floor[full] = self.score[np.searchsorted(self.query, full, "right") - 1]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.query), pa.array(self.score), pa.array(self.id, mask=self.none), pa.array(self.rid)],
            names=["query", "score", "id", "rid"])


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """int64 rows of a list column, filled up with zeros."""
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(ends))
    out[row, np.arange(len(flat)) - ends[row]] = flat
    return out


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(rid, id, label, v): the rows that take part, with whole-number components and a number of their own."""
    v = F.col(f"`{vector_col}`")
    real = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    return rows.where(real & label.isNotNull()).select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def _pass(rows: DataFrame, block: dict, bound: int, dims: int, size: int, negatives: bool) -> DataFrame:
    """Each task's first `size` rows of each query of a block. Queries: an anchor's same-label rows, or other-label rows within a window."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        anchors = shared.value
        numbers = Residues(bound)
        left = [numbers.of(anchors["v"][i:i + TILE[0]]) for i in range(0, len(anchors["v"]), TILE[0])]
        best = Best(len(anchors["anchor"]) if negatives else len(anchors["v"]), size)
        for batch in batches:
            none = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("id").fill_null(0).to_numpy()
            rids, labels = batch.column("rid").to_numpy(), batch.column("label").to_numpy()
            order = np.lexsort((rids, ids, none))
            for at in range(0, len(order), TILE[1]):
                some = order[at:at + TILE[1]]
                right = numbers.of(matrix(batch.column("v").take(pa.array(some)), dims))
                about = ids[some], none[some], rids[some]
                for tile, residues in enumerate(left):
                    low = tile * TILE[0]
                    scores = numbers.products(residues, right)
                    same = anchors["label"][low:low + len(scores), None] == labels[some][None, :]
                    if not negatives:
                        able = same & (anchors["rid"][low:low + len(scores), None] != rids[some][None, :])
                        best.add(scores, able, np.arange(low, low + len(scores)), *about)
                        continue
                    for turn in anchors["turns"]:  # queries that have no anchor twice
                        q = turn[(anchors["anchor"][turn] >= low) & (anchors["anchor"][turn] < low + len(scores))]
                        own = anchors["anchor"][q] - low
                        s = scores[own]
                        best.add(s, ~same[own] & (s >= anchors["low"][q][:, None]) & (s <= anchors["high"][q][:, None]), q, *about)
        yield best.batch()

    return rows.mapInArrow(run, BEST)


def _first(rows: DataFrame, size: int) -> DataFrame:
    """The first rows of each query with their rank; every task brings `size` of a query at most."""
    turn = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "rid")
    return rows.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= size)


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, anchors: str = "id % 100 = 0",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's positives.

    anchors: condition on id and label that marks the query set. A negative has another label and
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = rows.sparkSession
    kept = materialize(usable(rows, id_col, vector_col, F.col("`label`") if label is None else label, scale), "vectors")
    found = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    size = kept.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max("v")).alias("most"), F.min(F.array_min("v")).alias("least")).first()
    dims = size.dims or 0
    if not dims:
        dims, most = 1, 0
    else:
        most = max(abs(size.most), abs(size.least))
    bound = dims * most * most
    if bound >= 1 << 62:
        raise ValueError(f"components up to {most} in {dims} dimensions give scores beyond a long")
    asked = kept.where(anchors)
    per = max(1, BLOCK_BYTES // (8 * dims))
    blocks = math.ceil(asked.count() / per)
    # Anchors are dealt by a hash into blocks of about `per`, each read on its own, so the driver holds one block at a time.
    for number in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == number).orderBy("rid").toArrow()
        if not held.num_rows:
            continue
        block = {"v": matrix(held.column("v").combine_chunks(), dims), "label": held.column("label").to_numpy(), "rid": held.column("rid").to_numpy()}
        near = materialize(_first(_pass(kept, block, bound, dims, positives, False), positives), "positives")
        told = near.orderBy("query", "rank").toArrow()  # at most `positives` for each anchor of the block
        anchor, score = told.column("query").to_numpy(), told.column("score").to_numpy()
        if not len(anchor):
            continue
        rank = told.column("rank").to_numpy()
        block |= {"anchor": anchor, "turns": [np.flatnonzero(rank == r) for r in np.unique(rank)],
                  "low": np.array([-(-low * s // 100) for s in score.tolist()], np.int64),
                  "high": np.array([high * s // 100 for s in score.tolist()], np.int64)}
        far = _first(_pass(kept, block, bound, dims, negatives, True), negatives)
        names = pa.table({"query": np.arange(len(anchor)), "anchor_id": held.column("id").combine_chunks().take(pa.array(anchor)),
                          "positive_id": told.column("id").combine_chunks(), "positive_score": score})
        # One row for each positive of the block, as bounded as the block itself.
        found = found.unionByName(materialize(far.join(F.broadcast(spark.createDataFrame(names)), "query").select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")), "negatives"))
    return found


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    given = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    return mine(rows, label=label)
