"""Packing documents into token sequences by shortest-pack-first over the length histogram.

Documents are tokenized where they lie; only (id, start, length, checksum) of their pieces go on. Pieces longer than a
sequence do not exist: a document is cut at multiples of the sequence size. The histogram of piece lengths (at most
`size` numbers, whatever the corpus) is packed on the driver into patterns with counts, and the patterns are joined back
to the pieces by length and rank. Ranks are counted in hashed buckets with bucket offsets, so a length that a third of
all pieces share is no single task.

Defined results: a null text is empty and gives one piece that holds the end id only. Null ids are ids like any other;
repeated rows are documents of their own. An empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.wordtok import SLICE, word_tokenizer
from flowspark.session import materialize

SIZE = 4096
END_ID = 2
BUCKETS = 256

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ends of a string column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), ends


def token_lists(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text, in order; small texts are handled together."""
    words = word_tokenizer(path)
    data, ends = _texts(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE, "right")) - 1)
        if j == i + 1:
            yield words.ids(data[ends[i]:ends[j]])
        else:
            ids, cuts = words.batch(data[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
            yield from (ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        i = j


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most size ids of each document and its end id."""

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), token_lists(batch.column(1), tokenizer), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                rows += [(doc, at, min(size, len(ids) - at), zlib.crc32(ids[at:at + size].tobytes()), len(ids))
                         for at in range(0, len(ids), size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return source.mapInArrow(run, PIECES)


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, times), ...]) that hold counts[length] pieces of every length.

    Longest first; each length goes to the emptiest open pattern it fits, and a pattern met by fewer pieces than it has
    sequences is split in two. At most one split per length and new pattern, so the patterns are no more than 2 x size.
    """
    open_at: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    free: list[int] = []  # free lengths of open patterns, ascending
    done: list[tuple[int, list[tuple[int, int]]]] = []

    def put(room: int, number: int, held: list) -> None:
        if room == 0:
            done.append((number, held))
            return
        if room not in open_at:
            open_at[room] = []
            bisect.insort(free, room)
        open_at[room].append((number, held))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if free and free[-1] >= length:
                room = free[-1]
                number, held = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
                    free.pop()
            else:
                times = size // length  # new sequences, all of this length as far as it goes round
                room, number, held = size, max(1, left // times), []
            times = max(1, min(room // length, left // number)) if not held else 1
            used = min(number, left) if times == 1 else number
            if used < number and held:
                put(room, number - used, held)
            last = [(length, times)] if not held or held[-1][0] != length else [(length, held[-1][1] + times)]
            put(room - times * length, used, (held if not held or held[-1][0] != length else held[:-1]) + last)
            left -= used * times
    return done + [p for at in open_at.values() for p in at]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, times per sequence, first sequence, offset) of each pattern's lengths."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for number, held in patterns:
        offset = 0
        for length, times in held:
            low = taken.get(length, 0)
            taken[length] = low + number * times
            out.append((length, low, taken[length], times, sequence, offset))
            offset += length * times
        sequence += number
    return out


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows with `rank`, 0 .. n-1 within each key: counted in hashed buckets, moved on by the buckets before."""
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n")) \
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order)) - 1
    return dealt.withColumn("_inside", inside).join(offsets, [key, "_bucket"]) \
        .withColumn("rank", F.col("_inside") + F.col("_before")).drop("_bucket", "_inside", "_before")


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """parts (written pieces) with sequence_id and offset."""
    spark = parts.sparkSession
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(
        slots(pack_histogram(counts, size)) or [(0, 0, 0, 1, 0, 0)],
        "length long, _low long, _high long, _times long, _sequence long, _offset long")
    # At most 2 x size patterns of few lengths each: the table has a bound that no corpus moves.
    placed = ranked(parts, "length", ["doc_id", "start", "ids_crc32"]).join(F.broadcast(table), "length") \
        .where("rank >= _low AND rank < _high")
    at = F.col("rank") - F.col("_low")
    turn = F.floor(at / F.col("_times"))
    return placed.withColumn("sequence_id", (F.col("_sequence") + turn).cast("long")) \
        .withColumn("offset", (F.col("_offset") + F.pmod(at, F.col("_times")) * F.col("length")).cast("long")) \
        .drop("rank", "_low", "_high", "_times", "_sequence", "_offset")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of docs with their sequence and place in it."""
    return pack(materialize(pieces(docs, tokenizer, size, id_col, text_col), "pieces"), size)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
