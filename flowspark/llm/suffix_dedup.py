"""Substring dedup on bytes by suffix arrays: every byte covered by a 200-byte string that starts anywhere else goes.

Windows of 200 bytes are grouped into super-k-mers by minimiser, which shows which stretches can hold a repeated window
at all. Those stretches, each different one once, are dealt into shards of bounded size. A shard builds a suffix array of
its concatenated strings by Larsson-Sadakane refinement (only groups not yet told apart are sorted again, by the ranks of
the suffixes h further on), takes common prefixes by Kasai's method, and so knows which of its windows occur twice. Equal
windows share a minimiser and so a shard, unless a minimiser has more than `HOT` different stretches: it is then dealt
over several shards, and each pair of them is merged by binary search of the one's windows in the other's suffix array.

Defined results: null and empty texts have no bytes. Matches never cross documents, but may lie in one document and
overlap. Ids play no part in what is removed; null ids and repeated rows are documents like any other (a repeated row is
a copy, so both rows lose what they share). An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.supermers import PLACE, joined, placed, super_mers
from flowspark.llm.words import SLICE, TABLE, range_hashes, slices, texts
from flowspark.session import materialize

WINDOW = 200
GRAM = 24
#: Bytes of concatenated stretches in a shard, about.
SHARD = 2_000_000
#: Different stretches of a minimiser in one shard; more are dealt over several.
HOT = 4_000
#: Bits of the numbers in which group, rank and place are sorted at once; with more, two keys are sorted.
BITS = 64
#: Windows looked up at once in another shard's suffix array.
ASKED = 1 << 13


def byte_symbols(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return TABLE[data], ends


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of each suffix) of a byte array.

    Larsson-Sadakane: after a first sort by the symbols that fit one number, suffixes of a group that is not yet told apart
    are sorted by the rank of the suffix h further on, h doubling, until none is left. Shorter suffixes sort first.
    Sorted are plain numbers that end in the place they come from, which is much quicker than an indirect sort.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    used = np.bincount(data, minlength=256) > 0
    code = np.where(used, np.cumsum(used), 0).astype(np.uint64)  # 0: the suffix has ended
    wide, low = int(code.max()).bit_length(), (n - 1).bit_length()
    h, have = (64 - low) // wide, 1
    key = np.concatenate([code[data], np.zeros(h, np.uint64)])
    while have < h:
        step = min(have, h - have)
        key[:-step] = (key[:-step] << np.uint64(step * wide)) | key[step:]
        have += step
    order, fresh = _sorted(key[:n], low)
    head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.zeros(n + 1, np.int64)  # from 1; 0 past the end
    rank[order] = head + 1
    alone = fresh & np.r_[fresh[1:], True]
    open_ = np.flatnonzero(~alone)  # places in order whose group has more than one suffix
    at, fresh = order[open_], fresh[open_]
    while len(open_):
        second = rank[np.minimum(at + h, n)].view(np.uint64)
        group = np.cumsum(fresh)
        group -= 1
        low = (len(at) - 1).bit_length()
        if int(group[-1]).bit_length() + n.bit_length() + low <= BITS:
            group = group.view(np.uint64)
            group <<= np.uint64(n.bit_length())
            turn, fresh = _sorted(np.bitwise_or(group, second, out=group), low)
        else:
            turn = np.lexsort((second, group))
            second = second[turn]  # the groups stay where they are
            fresh[1:] |= second[1:] != second[:-1]
        at = at[turn]
        order[open_] = at
        rank[at] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))] + 1
        more = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
        open_, at, fresh = open_[more], at[more], fresh[more]
        h *= 2
    return order, rank[:n] - 1


def _sorted(key: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the keys in ascending order, which of them differ from the one before).

    Keys leave `low` bits for the place, and are overwritten.
    """
    key <<= np.uint64(low)
    key |= np.arange(len(key), dtype=np.uint64)
    key.sort()
    place = (key & np.uint64((1 << low) - 1)).view(np.int64)
    key >>= np.uint64(low)
    return place, np.r_[True, key[1:] != key[:-1]]


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, of the common prefix of each suffix in order with the one before it.

    Kasai's bound in vector form: a suffix shares with its neighbour at least what the suffix before it in the text shares
    with its own, less one. So lengths are settled for every most-th text position first, and the positions between start
    from their bound; each round extends all unsettled pairs by 8 bytes.
    """
    n = len(data)
    before = np.empty(n, np.int64)  # by text position: the neighbour before; n for the first suffix
    before[order[1:]] = order[:-1]
    before[order[:1]] = n
    length = np.zeros(n, np.int64)  # by text position
    wide = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray((n + 8,), np.dtype("<u8"), wide.tobytes(), 0, (1,))

    def extend(at: np.ndarray, have: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes at with their neighbours before, from what is known."""
        other = before[at]
        limit = np.minimum(n - np.maximum(at, other), most)
        have = np.minimum(have, limit)
        live = np.flatnonzero(have < limit)
        while len(live):
            x = eight[at[live] + have[live]] ^ eight[other[live] + have[live]]
            same = np.where(x == 0, 8, _low_byte(x))
            have[live] = np.minimum(have[live] + same, limit[live])
            live = live[(same == 8) & (have[live] < limit[live])]
        return have

    step = 32
    known = np.arange(0, n, step)
    length[known] = extend(known, np.zeros(len(known), np.int64))
    while step > 1:  # halve the distance between settled positions; each new one starts from its bound
        half = step // 2
        at = np.arange(half, n, step)
        length[at] = extend(at, np.maximum(length[at - half] - half, 0))
        step = half
    return length[order]


def _low_byte(x: np.ndarray) -> np.ndarray:
    """Number of equal low bytes before the first different one (x not zero)."""
    low = x & (~x + np.uint64(1))
    return (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)


def repeated_windows(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts of strings, suffix array, joined bytes, which bytes start a window that occurs twice)."""
    begin = np.cumsum([0, *map(len, strings)])
    data = np.frombuffer(b"".join(strings), np.uint8)
    order, rank = suffix_array(data)
    length = common_prefixes(data, order, rank, window)
    # A window must end inside its own string.
    ends = np.repeat(begin[1:], np.diff(begin))
    whole = np.arange(len(data)) + window <= ends
    # Suffixes too short to hold a window may stand between equal windows' suffixes; compare whole ones with each other.
    group = np.cumsum(length < window)
    mine = order[whole[order]]
    of = group[whole[order]]
    many = np.bincount(of, minlength=int(of[-1]) + 1 if len(of) else 0)
    twice = np.zeros(len(data), bool)
    twice[mine[many[of] > 1]] = True
    return begin, order, data, twice


def found_in(data: np.ndarray, order: np.ndarray, queries: np.ndarray, window: int) -> np.ndarray:
    """Which windows (rows of bytes) occur in data, by binary search in its suffix array."""
    pad = -window % 8
    wide = np.concatenate([data, np.zeros(window + pad, np.uint8)])

    def words(rows: np.ndarray) -> np.ndarray:
        rows = np.pad(rows, ((0, 0), (0, pad)))
        return rows.reshape(len(rows), -1, 8).view("<u8")[:, :, 0]

    q, at_place = words(queries), np.lib.stride_tricks.sliding_window_view(wide, window)
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(order))
    found = np.zeros(len(q), bool)
    while (low < high).any():
        live = np.flatnonzero(low < high)
        mid = (low[live] + high[live]) // 2
        at = order[np.minimum(mid, len(order) - 1)]
        rows = words(at_place[at])
        differ = rows != q[live]
        first = differ.argmax(1)
        apart = differ[np.arange(len(live)), first]
        less = apart & (rows[np.arange(len(live)), first].byteswap() < q[live, first].byteswap())
        equal = ~apart & (at + window <= len(data))
        less |= ~apart & ~equal  # a suffix that ends early stands before the window it begins
        found[live[equal]] = True
        low[live] = np.where(equal, high[live], np.where(less, mid + 1, low[live]))
        high[live] = np.where(less | equal, high[live], mid)
    return found


def _shard(window: int):
    """Ranges of repeated windows of a shard's strings, or of a pair of shards of one minimiser."""
    def run(table: pa.Table) -> pa.Table:
        strings = table.column("packed").to_pylist()
        block, a, b = (table.column(c).to_numpy() for c in ("block", "a", "b"))
        copies = table.column("copies").to_numpy()
        if not len(strings) or a[0] == b[0]:
            begin, _, data, twice = repeated_windows(strings, window)
            for r in np.flatnonzero(copies > 1):
                twice[begin[r]:begin[r + 1] - window + 1] = True
        else:
            size = np.array([*map(len, strings)])
            begin, whole = np.r_[0, np.cumsum(size)], np.frombuffer(b"".join(strings), np.uint8)
            twice, windows = np.zeros(len(whole), bool), np.lib.stride_tricks.sliding_window_view(whole, window)
            of, inside = np.repeat(block, size), np.arange(len(whole)) + window <= np.repeat(begin[1:], size)
            for here, there in ((a[0], b[0]), (b[0], a[0])):
                data = whole[of == there]
                order, _ = suffix_array(data)
                order = order[inside[of == there][order]]
                at = np.flatnonzero(inside & (of == here))
                for i in range(0, len(at), ASKED):
                    twice[at[i:i + ASKED]] = found_in(data, order, windows[at[i:i + ASKED]], window)
        return _ranges(table, begin, twice)

    return run


def _ranges(table: pa.Table, begin: np.ndarray, twice: np.ndarray) -> pa.Table:
    edge = np.zeros(len(twice) + 1, bool)
    edge[begin] = True
    head = np.flatnonzero(twice & (edge[:-1] | ~np.r_[False, twice[:-1]]))
    tail = np.flatnonzero(twice & (edge[1:] | ~np.r_[twice[1:], False])) + 1
    owner = np.searchsorted(begin, head, "right") - 1
    return pa.table({"m": table.column("m").to_numpy()[owner], "s": table.column("s").to_numpy()[owner],
                     "low": head - begin[owner], "size": tail - head})


def _strings(batches, window: int, size: int = SLICE):
    """The parts (m, s, copies, shards) that the texts hold at the places stated, with their bytes; a batch per slice of texts."""
    for batch in batches:
        parts = batch.column("parts")
        many = parts.value_lengths().to_numpy()
        cut = np.r_[0, np.cumsum(many)]
        column = dict(zip((f.name for f in parts.type.value_type), parts.flatten().flatten(), strict=True))
        start, windows, s = (column[c].to_numpy() for c in ("start", "windows", "s"))
        for i, j, data, ends in slices(batch.column("text"), size):
            mine = slice(cut[i], cut[j])
            row = np.repeat(np.arange(j - i), many[i:j])
            first = ends[row] + start[mine]
            last = first + windows[mine] + window - 1
            inside = np.flatnonzero(last <= ends[row + 1])
            first, last = first[inside], last[inside]
            here = range_hashes(TABLE[data], first, last).view(np.int64) == s[mine][inside]
            taken, raw = pa.array(inside[here] + cut[i]), data.tobytes()
            packed = [raw[a:b] for a, b in zip(first[here].tolist(), last[here].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(column[c].take(taken) for c in ("m", "s", "copies", "shards")), pa.array(packed, pa.binary())],
                                             names=["m", "s", "copies", "shards", "packed"])


def _packed(source: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    return joined(source, wanted).mapInArrow(lambda batches: _strings(batches, window),
                                             "m long, s long, copies long, shards long, packed binary")


def removed_spans(source: DataFrame, window: int = WINDOW, gram: int = GRAM, size: int = SLICE) -> DataFrame:
    """Places with the byte ranges to remove: _none, _id, _h, _n, spans (array of from, to; may overlap)."""
    mers = materialize(super_mers(source, byte_symbols, window, gram, anchors=True, size=size), "supermers")
    shared = mers.groupBy("m").agg(F.sum("anchors").alias("n")).where("n > 1").select("m")
    shared = materialize(shared, "shared_minimisers")  # written, so that a hot minimiser's side of the join can be split
    mine = materialize(mers.join(shared, "m").drop("anchors"), "shared_supermers")

    strings = materialize(mine.groupBy("m", "s").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*PLACE, "start")).alias("p"), F.first("windows").alias("windows")), "strings")
    per = strings.groupBy("m").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HOT) \
        .select("m", F.ceil(F.col("k") / HOT).alias("shards"))
    wanted = materialize(strings.join(per, "m", "left").groupBy(*[f"p.{c}" for c in PLACE]).agg(F.collect_list(F.struct(
        "m", "s", "p.start", "windows", "copies", F.coalesce("shards", F.lit(1)).alias("shards"))).alias("parts")), "wanted")

    total = strings.agg(F.sum(F.col("windows") + window - 1)).first()[0] or 0
    shards = max(1, total // SHARD)
    mine_block = F.pmod(F.xxhash64("s"), F.col("shards"))
    # Ordinary minimisers: many in a shard. Hot ones: their own blocks, and pairs of blocks.
    found = _packed(source, wanted, window).withColumn("block", mine_block) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))) \
        .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")) \
        .withColumn("own", F.when(F.col("shards") > 1, F.col("m")).otherwise(F.pmod(F.xxhash64("m"), F.lit(shards)))) \
        .withColumn("hot", F.col("shards") > 1) \
        .groupBy("hot", "own", "a", "b").applyInArrow(_shard(window), "m long, s long, low long, size long")
    ranges = mine.join(materialize(found, "window_ranges"), ["m", "s"])
    low = F.col("start") + F.col("low")
    return ranges.groupBy(*PLACE).agg(F.collect_set(F.struct(low.alias("from"), (low + F.col("size") + window - 1).alias("to"))).alias("spans"))


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SLICE) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, kept (the bytes that stay), spans (maximal byte ranges removed)."""
    source = placed(docs, id_col, text_col)
    spans = materialize(removed_spans(source, window, gram, size), "spans")
    return joined(source, spans, "left").mapInArrow(
        _keep, "doc_id long, n_bytes long, kept binary, spans array<struct<from:long,to:long>>")


def _keep(batches):
    for batch in batches:
        none, ids, found = (batch.column(c).to_pylist() for c in ("_none", "_id", "spans"))
        data, ends = texts(batch.column("text"))
        out = []
        for r in range(len(ids)):
            text = data[ends[r]:ends[r + 1]].tobytes()
            merged: list[list[int]] = []
            for low, high in sorted((x["from"], x["to"]) for x in found[r] or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = [], 0
            for low, high in merged:
                kept.append(text[at:low])
                at = high
            kept.append(text[at:])
            out.append((None if none[r] else ids[r], len(text), b"".join(kept), [{"from": a, "to": b} for a, b in merged]))
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, [pa.int64(), pa.int64(), pa.binary(), span], strict=True)],
            names=["doc_id", "n_bytes", "kept", "spans"])


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicated(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
