"""Labelled rows for fitting: a bounded sample, fetched without moving the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ids of each class that go into a sample before others, however rare the class is.
PER_CLASS = 500


def held_out(doc_id: Column) -> Column:
    """Rows no label may be learned from: crc32 of the id as text leaves remainder 1 by 3. Null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(3)) == 1, F.lit(False))


def bounded_sample(labels: DataFrame, max_rows: int, class_col: str = "label", per_class: int = PER_CLASS) -> DataFrame:
    """One row for each of at most max_rows ids: those least in a hash of the id, whatever the partitioning.

    The first per_class ids of each class go before all others, so that a rare class is learned too. An id with several
    rows counts once, with the least of them; null ids never.
    """
    others = [c for c in labels.columns if c != "doc_id"]
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_row")) \
        .select("doc_id", "_row.*", F.xxhash64("doc_id").alias("_turn"))
    turn = Window.partitionBy(class_col).orderBy("_turn", "doc_id")
    rare = one.withColumn("_rank", F.row_number().over(turn)).where(F.col("_rank") <= per_class)
    first = one.orderBy("_turn", "doc_id").limit(max_rows).withColumn("_rank", F.lit(per_class + 1))
    both = rare.unionByName(first).groupBy("doc_id", "_turn", *others).agg(F.min("_rank").alias("_rank"))
    return both.orderBy("_rank", "_turn", "doc_id").limit(max_rows).drop("_turn", "_rank")


def named(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows of docs with an id of a bounded sample, and its columns; the sample's size is its bound, so it is broadcast."""
    return docs.join(F.broadcast(sample), "doc_id")


def one_each(rows: DataFrame) -> DataFrame:
    """One row for each doc_id, the least, by a partial minimum in each task: what is fetched is as bounded as the sample."""
    others = [c for c in rows.columns if c != "doc_id"]
    return rows.groupBy("doc_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_row")).select("doc_id", "_row.*")
