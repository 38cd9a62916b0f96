"""Exact duplicates by content-defined chunk recipes; DataFrame functions only.

A text is cut where its own content says so, so equal stretches of different texts give equal chunks. Every distinct
chunk moves once, to be verified: an identifier that two different chunks share would show there and is replaced. After
that a document is a short ordered list of identifiers (its recipe), and only recipes are grouped and joined.

Defined results: a null text counts as empty, and all empty texts are equal. A null id ranks after every id; a group
with null ids only has a null keep_id. Of rows with the same id and equal texts one is kept. An empty table gives an
empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import materialize

#: White space between words, as in the contract: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
#: The same, sparing single spaces: replaces the same with far fewer replacements.
_ODD_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
#: A chunk ends after at least 256 characters at the first word ending in one of these letters, or after 4096.
CHUNK = r"(?s).{256,4096}?(?:[aemnor] |\z)|.{1,4096}"
#: Identifiers shared by different chunks are listed in the plan up to this number; beyond it chunks stand for themselves.
LISTED = 1000


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACE, " ")


def chunks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_id(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk))


def verified_id(chunks: DataFrame):
    """Function from a chunk to its verified identifier. chunks: all chunks, in column `chunk`.

    Equal identifiers of different chunks are looked for over all chunks; such identifiers get the chunk appended.
    """
    distinct = chunks.select(chunk_id(F.col("chunk")).alias("cid"), "chunk").groupBy("cid", "chunk").agg(F.count(F.lit(1)))
    shared = [r.cid for r in distinct.groupBy("cid").count().where("count > 1").limit(LISTED + 1).collect()]
    if len(shared) > LISTED:
        return lambda chunk: F.encode(chunk, "utf-8")
    if not shared:
        return chunk_id
    bad = F.array(*[F.lit(bytes(c)) for c in shared])
    return lambda chunk: F.when(F.array_contains(bad, chunk_id(chunk)), F.concat(chunk_id(chunk), F.encode(chunk, "utf-8"))) \
        .otherwise(chunk_id(chunk))


def recipes(docs: DataFrame, text_col: str = "text"):
    """Column expression of the recipe of a row of docs, over identifiers verified against all of docs."""
    norm = normalized(F.col(f"`{text_col}`"))
    ident = verified_id(docs.select(F.explode(chunks_of(norm)).alias("chunk")))
    return F.transform(chunks_of(norm), ident)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: its id, keep_id, group_size, kept, text_sha256 (normalised text) and n_chunks."""
    norm = normalized(F.col(f"`{text_col}`"))
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.sha2(F.encode(norm, "utf-8"), 256).alias("text_sha256"),
        recipes(docs, text_col).alias("recipe"),
    ), "recipes")
    same = rows.groupBy("doc_id", "recipe", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    groups = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return (
        same.join(groups, "recipe")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select("doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                "text_sha256", F.size("recipe").alias("n_chunks"))
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_duplicates drops; all columns as they are.

    Rows that tie in id and text are told apart by a hash of the whole row. A row is ranked within its recipe; all but
    the first of a map task's rows of a recipe go before the shuffle, so a large group is no large partition.
    """
    names = docs.columns
    order = F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    packed = docs.select(recipes(docs, text_col).alias("recipe"), order.alias("place"),
                         F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    first = F.row_number().over(Window.partitionBy("recipe").orderBy("place"))
    return packed.withColumn("nth", first).where("nth = 1").select("row.*")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).drop("n_chunks")
