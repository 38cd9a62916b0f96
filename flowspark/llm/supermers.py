"""Super-k-mers: runs of consecutive windows that share a minimiser, as rows that find their equals by it.

A window is `window` consecutive symbols of one document (words or bytes). Its minimiser is the least hash among its
grams, a function of its content alone, so equal windows share it wherever they stand; consecutive windows with one
minimiser form a super-k-mer of `windows` windows. Only (document, minimiser, content hash, place) travel at first:
minimisers that cannot hold a repeated window are dropped before any text moves, and super-k-mers with equal content
are one row from then on, however many copies there are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.words import SLICE, gram_hashes, range_hashes, slices, sliding_min

#: Places (21 bytes each) up to which they are broadcast to the texts; a shuffled join beyond it.
BROADCAST_ROWS = 200_000
#: Ids that stand in for null: after every id.
LAST = (1 << 63) - 1

PLACE = ("_none", "_id", "_h", "_n")


def runs(values: np.ndarray, cuts: np.ndarray, window: int, gram: int, anchors: bool = False):
    """(document, start, windows, minimiser, content hash[, grams that are the minimum]) of every super-k-mer.

    values: a hash for every symbol; cuts: where documents begin, and the end.
    """
    mins = gram_hashes(values, gram)
    least = sliding_min(mins, window - gram + 1)
    n = len(least)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), np.empty(0, np.uint64), none
    edge = np.zeros(n + 1, np.int64)
    ends = cuts[1:]
    np.add.at(edge, np.clip(ends - window + 1, 0, n), 1)
    np.add.at(edge, np.clip(ends, 0, n), -1)
    outside = np.cumsum(edge[:n]) > 0  # windows that would reach into the next document
    fresh = ~outside
    fresh[1:] &= outside[:-1] | (least[1:] != least[:-1])
    stop = np.r_[np.flatnonzero(fresh | outside), n]
    start = np.flatnonzero(fresh)
    end = stop[np.searchsorted(stop, start, "right")]
    count = np.zeros(len(start), np.int64)
    if anchors and len(start):
        width = window - gram + 1
        held = np.where(outside, 0, least)
        wide = np.concatenate([np.zeros(width - 1, np.uint64), held, np.zeros(width - 1, np.uint64)])
        most = ~sliding_min(~wide, width)  # for each gram, the greatest minimum of the windows it lies in
        place = np.flatnonzero(mins == most)
        names = np.unique(least[start])
        known = np.searchsorted(names, mins[place])
        real = (known < len(names)) & (names[np.minimum(known, len(names) - 1)] == mins[place])
        key = np.sort((known[real] << 40) + place[real])
        mine = np.searchsorted(names, least[start]) << 40
        count = np.searchsorted(key, mine + end + width - 1) - np.searchsorted(key, mine + start)
    document = np.searchsorted(cuts, start, "right") - 1
    return document, start, end - start, least[start], range_hashes(values, start, end + window - 1), count


def place_columns(id_col: str = "doc_id", text_col: str = "text") -> list:
    """Columns that find a row again: its id, null or not, and a 64-bit hash and the bytes of its text.

    Many rows may share an id (all null ones do), so the text's part has to tell them apart by itself.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return [F.col(f"`{id_col}`").isNull().alias("_none"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("_id"),
            F.xxhash64(text).alias("_h"), F.octet_length(text).alias("_n")]


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(*place_columns(id_col, text_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def super_mers(source: DataFrame, symbols: Callable, window: int, gram: int, anchors: bool = False, size: int = SLICE) -> DataFrame:
    """One row per super-k-mer of the placed texts. symbols(bytes, ends) gives a hash per symbol and the documents' cuts."""
    def rows(batches):
        for batch in batches:
            for i, _, data, ends in slices(batch.column(len(PLACE)), size):
                values, cuts = symbols(data, ends)
                # A long document goes in overlapping pieces: every window lies in exactly one of them.
                for at in range(0, max(1, len(values) - window + 1), size) if len(cuts) == 2 else (0,):
                    part = values[at:at + size + window - 1] if len(cuts) == 2 else values
                    inner = cuts if len(cuts) > 2 else np.array([0, len(part)])
                    doc, start, count, m, s, n = runs(part, inner, window, gram, anchors)
                    start = start - inner[doc]
                    where = pa.array(doc + i)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(where) for c in range(len(PLACE))), pa.array(m.view(np.int64)), pa.array(s.view(np.int64)),
                         pa.array(start + at), pa.array(count.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=[*PLACE, "m", "s", "start", "windows", "anchors"])

    return source.mapInArrow(rows, "_none boolean, _id long, _h long, _n int, m long, s long, start long, windows int, anchors int")


def held(values: np.ndarray, parts: list[dict], window: int) -> list[dict]:
    """The parts (m, s, start, windows ..) that a text with these symbols has: content hash s at the place stated."""
    first = np.fromiter((p["start"] for p in parts), np.int64, len(parts))
    last = first + np.fromiter((p["windows"] for p in parts), np.int64, len(parts)) + window - 1
    inside = np.flatnonzero(last <= len(values))
    s = range_hashes(values, first[inside], last[inside]).view(np.int64)
    return [parts[i] for i, found in zip(inside.tolist(), s.tolist(), strict=True) if parts[i]["s"] == found]


def joined(source: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """Placed texts with the rows of wanted (written, at most one per place); how: inner or left.

    While wanted names no more than BROADCAST_ROWS places, only their keys are broadcast, and only the texts they name are
    moved; with more, all texts are.
    """
    if wanted.count() > BROADCAST_ROWS:
        return source.join(wanted, list(PLACE), how)
    keys = F.broadcast(wanted.select(*PLACE))
    named = source.join(keys, list(PLACE), "left_semi").join(wanted, list(PLACE))
    if how == "inner":
        return named
    others = source.join(keys, list(PLACE), "left_anti")
    return named.unionByName(others, allowMissingColumns=True)
