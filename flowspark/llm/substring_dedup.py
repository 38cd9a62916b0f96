"""Substring dedup on word windows by super-k-mer partitioning.

Words (runs without white space) of every whole text; a window is 50 consecutive words. Consecutive windows that share a
minimiser travel as one packed string (their words, one space between) to the minimiser's bucket. There the windows of
all strings are ranked exactly, by sorting pairs of ranks of half-windows over the bucket's own words, and every window
learns the smallest doc_id it starts in. Each document then drops the words of its windows that start in a smaller one.

Buckets are bounded: minimisers with one document only never travel, equal strings travel once, and the strings of a
minimiser with more than `HOT` different ones, or more than `WORDS` words, are dealt over shards by their hash. A shard
reduces its windows to the different ones (a 128-bit digest and the smallest doc_id each), the shards' minima are merged
by digest, and what another shard has smaller comes back to it. So a window that stands in every string is one row of
each shard, however many strings there are.

Defined results: null and empty texts have no words and keep nothing. A null doc_id counts as greater than every id, and
rows with equal ids (null or not) never remove each other's words. An empty table gives an empty table. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations


from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.supermers import PLACE, held, joined, placed, super_mers
from flowspark.llm.words import SLICE, span_hashes, spans
from flowspark.session import materialize

WINDOW = 50
GRAM = 8
#: Different strings of one minimiser in one shard; more are dealt over several.
HOT = 20_000
#: Packed strings in a bucket, about.
BUCKET = 20_000
#: Words of packed strings in a bucket or shard, about; a string has at most a slice's.
WORDS = 4_000_000


def word_symbols(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, last = spans(data, ends)
    return span_hashes(data, first, last), np.searchsorted(first, ends)


def _packed(source: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(m, s, shards, windows, least, most, packed): the strings of wanted super-k-mers."""
    def rows(batches):
        for batch in batches:
            parts = batch.column("parts").to_pylist()
            for r, text in enumerate(batch.column("text").to_pylist()):
                data = text.encode()
                words = data.split()
                values, _ = word_symbols(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
                out = [(p["m"], p["s"], p["shards"], p["windows"], p["least"], p["most"],
                        b" ".join(words[p["start"]:p["start"] + p["windows"] + window - 1])) for p in held(values, parts[r], window)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, [*[pa.int64()] * 6, pa.binary()], strict=True)],
                    names=["m", "s", "shards", "windows", "least", "most", "packed"])

    return joined(source, wanted).mapInArrow(rows, "m long, s long, shards long, windows long, least long, most long, packed binary")


def window_ranks(words: np.ndarray, window: int) -> np.ndarray:
    """Exact rank of the `window` symbols from each place: equal ranks, equal windows."""
    rank, have = words.astype(np.int64), 1
    while have < window:
        step = min(have, window - have)
        rank = np.unique((rank[:-step] << 32) | rank[step:], return_inverse=True)[1]
        have += step
    return rank


class _Windows:
    """The windows of a bucket's strings, in a row, and which of them are equal."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window = table, window
        self.strings = [x.split(b" ") for x in table.column("packed").to_pylist()]
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for s in self.strings for w in s), np.int64)
        windows = table.column("windows").to_numpy()
        begin = np.cumsum([0, *map(len, self.strings)])[:-1]
        self.owner = np.repeat(np.arange(len(windows)), windows)
        self.inside = np.arange(len(self.owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        rank = window_ranks(words, window)[begin[self.owner] + self.inside]
        self.order = np.argsort(rank, kind="stable")
        ranked = rank[self.order]
        self.head = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        #: Smallest id of each different window.
        self.least = np.minimum.reduceat(table.column("least").to_numpy()[self.owner][self.order], self.head)

    def digests(self) -> list[bytes]:
        """128 bits of each different window's words."""
        at = self.order[self.head]
        return [blake2b(b" ".join(self.strings[r][i:i + self.window]), digest_size=16).digest()
                for r, i in zip(self.owner[at].tolist(), self.inside[at].tolist(), strict=True)]

    def ranges(self) -> pa.Table:
        """Runs of each string's windows with one smallest id, where some document of the string comes later."""
        owner, inside, first = self.owner, self.inside, np.empty(len(self.owner), np.int64)
        first[self.order] = np.repeat(self.least, np.diff(np.r_[self.head, len(first)]))
        at = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (first[1:] != first[:-1])])
        size = np.diff(np.r_[at, len(owner)])
        useful = first[at] < self.table.column("most").to_numpy()[owner[at]]
        at, size = at[useful], size[useful]
        o = owner[at]
        return pa.table({"m": self.table.column("m").to_numpy()[o], "s": self.table.column("s").to_numpy()[o],
                         "low": inside[at], "size": size, "first_id": first[at]})


RANGES = "m long, s long, low long, size long, first_id long"


def _count_windows(window: int):
    def run(table: pa.Table) -> pa.Table:
        return _Windows(table, window).ranges()

    return run


def _shard_windows(window: int):
    """The different windows of a shard."""
    def run(table: pa.Table) -> pa.Table:
        found = _Windows(table, window)
        n = len(found.head)
        return pa.table({**{c: pa.array(np.full(n, table.column(c)[0].as_py()), pa.int64()) for c in ("m", "shard")},
                         "digest": pa.array(found.digests(), pa.binary()), "least": found.least})

    return run


def _shard_ranges(window: int):
    """Ranges of a shard's strings, after the smaller ids that other shards have for its windows."""
    def run(table: pa.Table, smaller: pa.Table) -> pa.Table:
        found = _Windows(table, window)
        if len(smaller):
            known = dict(zip(smaller.column("digest").to_pylist(), smaller.column("first").to_pylist(), strict=True))
            found.least = np.fromiter(map(known.get, found.digests(), found.least.tolist()), np.int64)
        return found.ranges()

    return run


def _over_shards(hot: DataFrame, window: int) -> DataFrame:
    """Ranges of the strings (written) of minimisers that are dealt over shards."""
    dealt = hot.withColumn("shard", F.pmod(F.xxhash64("s"), F.col("shards")))
    windows = materialize(dealt.groupBy("m", "shard").applyInArrow(
        _shard_windows(window), "m long, shard long, digest binary, least long"), "shard_windows")
    firsts = windows.groupBy("m", "digest").agg(F.min("least").alias("first"), F.max("least").alias("last")).where("first < last")
    smaller = windows.join(firsts, ["m", "digest"]).where("first < least").select("m", "shard", "digest", "first")
    return dealt.groupBy("m", "shard").cogroup(smaller.groupBy("m", "shard")).applyInArrow(_shard_ranges(window), RANGES)


def removed_spans(source: DataFrame, window: int = WINDOW, gram: int = GRAM, size: int = SLICE) -> DataFrame:
    """Places with the word ranges to remove: _none, _id, _h, _n, spans (array of from, to; may overlap)."""
    mers = materialize(super_mers(source, word_symbols, window, gram, size=size).drop("anchors"), "supermers")
    shared = mers.groupBy("m").agg(F.min("_id").alias("x"), F.max("_id").alias("y")).where("x < y").select("m")
    shared = materialize(shared, "shared_minimisers")  # written, so that a hot minimiser's side of the join can be split
    mine = materialize(mers.join(shared, "m"), "shared_supermers")

    strings = mine.groupBy("m", "s").agg(
        F.min("_id").alias("least"), F.max("_id").alias("most"), F.min(F.struct(*PLACE, "start")).alias("p"), F.first("windows").alias("windows"))
    strings = materialize(strings, "strings")
    words = F.sum(F.col("windows") + window - 1)
    shards = F.ceil(F.greatest(F.count(F.lit(1)) / HOT, words / WORDS))
    hot = materialize(strings.groupBy("m").agg(shards.alias("shards")).where("shards > 1"), "hot_minimisers")
    wanted = strings.join(hot, "m", "left").groupBy(*[f"p.{c}" for c in PLACE]).agg(F.collect_list(F.struct(
        "m", "s", "p.start", "windows", "least", "most", F.coalesce("shards", F.lit(1)).alias("shards"))).alias("parts"))
    wanted = materialize(wanted, "wanted")

    count, total = strings.agg(F.count(F.lit(1)), words).first()
    buckets = max(1, count // BUCKET, (total or 0) // WORDS)
    packed = _packed(source, wanted, window)
    many = not hot.isEmpty()
    if many:
        packed = materialize(packed, "packed")
    found = packed.where("shards = 1").withColumn("bucket", F.pmod(F.xxhash64("m"), F.lit(buckets))) \
        .groupBy("bucket").applyInArrow(_count_windows(window), RANGES)
    if many:
        found = found.unionByName(_over_shards(packed.where("shards > 1"), window))
    ranges = mine.join(materialize(found, "window_counts"), ["m", "s"]).where("first_id < _id")
    low = F.col("start") + F.col("low")
    return ranges.groupBy(*PLACE).agg(F.collect_list(F.struct(low.alias("from"), (low + F.col("size") + window - 1).alias("to"))).alias("spans"))


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SLICE) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept (the text that stays), spans (word ranges removed)."""
    source = placed(docs, id_col, text_col)
    spans_ = materialize(removed_spans(source, window, gram, size), "spans")
    return joined(source, spans_, "left").mapInArrow(
        _keep, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<from:long,to:long>>")


def _keep(batches):
    for batch in batches:
        none, ids, found = (batch.column(c).to_pylist() for c in ("_none", "_id", "spans"))
        out = []
        for r, text in enumerate(batch.column("text").to_pylist()):
            words = text.encode().split()
            merged: list[list[int]] = []
            for low, high in sorted((x["from"], x["to"]) for x in found[r] or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = [], 0
            for low, high in merged:
                kept += words[at:low]
                at = high
            kept += words[at:]
            out.append((None if none[r] else ids[r], len(words), len(words) - len(kept), b" ".join(kept).decode(),
                        [{"from": a, "to": b} for a, b in merged]))
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, [pa.int64(), pa.int64(), pa.int64(), pa.string(), span], strict=True)],
            names=["doc_id", "n_words", "n_removed", "kept", "spans"])


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50),
h AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS k FROM p),
b AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM b WHERE gone),
d AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id),
a AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM t),
k AS (
  SELECT a.doc_id, string_agg(a.w[a.j], ' ' ORDER BY a.j) AS kept FROM a LEFT JOIN c ON c.doc_id = a.doc_id AND c.j = a.j
  WHERE c.j IS NULL GROUP BY a.doc_id)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(len(d.js), 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM t LEFT JOIN d USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))
