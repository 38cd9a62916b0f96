"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of n characters that occurs in a document with at most k edits shares at least (n - q + 1) - k q of its q-grams
with the matched region, on diagonals no more than k apart. So the shared q-grams of every document and item are counted
in diagonal bands 2(k + 1) wide that overlap by half; bands under the bound cannot hold a match and go, the rest are
verified by banded alignment (`Band`: the band's diagonals are the bits of one number, a row costs a dozen operations on
it). Items that begin alike share their rows and die together, so a stem of many items is aligned once for a place.
Nothing is sampled: the bound loses no match.

Text is lower-cased and runs of white space count as one space. k is `error_rate` of the item's length, lowered where a
short item could not keep `MIN_SHARED` q-grams; an item shorter than q + MIN_SHARED - 1 characters says nothing about a leak
and never matches. Only a whole item counts: part of one, however long, is no match. The benchmark is taken in blocks of `BLOCK_CHARS` characters; each block is a stated query set that
is held against all documents where they lie, so neither driver nor tasks hold more than one block's index.

Defined results: null and empty texts are clean; null ids are kept as they are; repeated rows are judged each on their
own; an empty benchmark leaves everything clean; an empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 10
ERROR_RATE = 0.1
MIN_SHARED = 8
BLOCK_CHARS = 4_000_000
#: Shared q-grams looked at together.
HITS = 1 << 19
#: Characters of documents handled at a time inside a task.
SLICE = 1 << 18

MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def normalized(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hash of the q characters from each place; combines shorter hashes by doubling."""
    if len(points) < q:
        return np.empty(0, np.uint64)
    h, size = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(31)
    while size < q:
        step = min(size, q - size)
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:] * np.uint64(0xCA5A826395121157)
        h ^= h >> np.uint64(32)
        size += step
    return h * np.uint64(0x9E3779B97F4A7C15)


def edit_budget(n: int, q: int = Q, rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item of n characters; -1 if it is too short to be matched."""
    return min(int(rate * n), (n - q + 1 - MIN_SHARED) // q) if n >= q + MIN_SHARED - 1 else -1


def masks(region: np.ndarray) -> dict[int, int]:
    """For each character of a region the places that hold it, as the bits of one number."""
    order = np.argsort(region, kind="stable")
    names, first = np.unique(region[order], return_index=True)
    out = {}
    for c, places in zip(names.tolist(), np.split(order, first[1:]), strict=True):
        bits = np.zeros(len(region), np.uint8)
        bits[places] = 1
        out[c] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return out


class Band:
    """Alignment of items with a band of diagonals of a text, a row of the table at a time, all diagonals in one number.

    Bit p stands for diagonal p: character i of an item meets character i + p of the region. Rows are kept, so the next
    item goes on from where it parts with the one before; once every diagonal has more than k edits the row is dead, and with
    it all items that begin alike. Costs along a row are kept as steps up and down, and the cost on diagonal 0.
    """

    def __init__(self, region: np.ndarray, width: int, k: int, up: int = 0, down: int = 0, cost: int = 0):
        """up, down: steps of the first row (none: an item may begin anywhere); cost: that on diagonal 0."""
        self.at, self.width, self.k, self.full = masks(region), width, k, (1 << width) - 1
        self.rows, self.item, self.dead = [(up, down, cost)], np.empty(0, np.uint32), None

    def costs(self) -> np.ndarray:
        """Edits on each diagonal in the last row."""
        up, down, cost = self.rows[-1]
        n = (self.width + 7) // 8
        bits = [np.unpackbits(np.frombuffer(x.to_bytes(n, "little"), np.uint8), bitorder="little")[:self.width - 1].astype(np.int64) for x in (up, down)]
        return cost + np.concatenate([[0], np.cumsum(bits[0] - bits[1])])

    def align(self, item: np.ndarray) -> bool:
        """Whether some diagonal ends with at most k edits."""
        n = min(len(item), len(self.item))
        apart = np.flatnonzero(item[:n] != self.item[:n])
        same = int(apart[0]) if len(apart) else n
        self.item = item
        if self.dead is not None and same >= self.dead:
            return False
        self.dead = None
        del self.rows[same + 1:]
        up, down, cost = self.rows[-1]
        at, full, rows = self.at, self.full, self.rows
        for i, c in enumerate(item[len(rows) - 1:].tolist(), len(rows) - 1):
            meets = (at.get(c, 0) >> i) & full
            level = ((((meets & up) + up) ^ up) | meets | down) & full
            right, left = (down | ~(level | up)) & full, level & up
            up, down = (left | ~((level >> 1) | right)) & full, (level >> 1) & right
            cost += 1 - (level & 1)
            rows.append((up, down, cost))
            if cost - down.bit_count() > self.k or (i % 16 == 15 and self.costs().min() > self.k):
                self.dead = i + 1
                return False
        return int(self.costs().min()) <= self.k


def place_of(item: np.ndarray, text: np.ndarray, end: int, k: int) -> int:
    """Where the part of text that ends at `end` and is nearest to the item begins, within k edits."""
    low = max(0, end - len(item) - k)
    region = text[low:end][::-1]
    # Diagonals -k .. k from the end backwards; before the end nothing is there, which costs as much as leaving it out.
    padded = np.concatenate([np.full(k, 0xFFFFFFFF, np.uint32), region])
    width = 2 * k + 1
    ones = (1 << width) - 1
    band = Band(padded, width, len(item) + 2 * k, up=ones & ~((1 << k) - 1), down=(1 << k) - 1, cost=k)
    band.align(item[::-1])
    costs = band.costs()
    return max(low, end - (len(item) + int(np.argmin(costs)) - k))


class Index:
    """q-grams of a block of items: sorted hashes with the places that have them, and a bit table in front."""

    BITS = 22

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = ERROR_RATE):
        self.q = q
        kept = [(i, p, k) for i, t in items if (k := edit_budget(len(p := codes(normalized(t))), q, rate)) >= 0]
        self.ids, self.points = [i for i, _, _ in kept], [p for _, p, _ in kept]
        self.k = np.array([k for _, _, k in kept], np.int64)
        grams = [gram_hashes(p, q) for p in self.points]
        sizes = [len(g) for g in grams]
        self.size = np.array([len(p) for p in self.points], np.int64)
        self.turn = np.empty(len(kept), np.int64)
        self.turn[sorted(range(len(kept)), key=lambda i: self.points[i].tolist())] = np.arange(len(kept))
        self.need = np.array([n - k * q for n, k in zip(sizes, self.k, strict=True)], np.int64)
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(kept)), sizes)
        at = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in text, item, place in item) of every shared q-gram, in blocks of about HITS in the text's order."""
        maybe = np.flatnonzero(self.bits[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.keys):
            return
        slot = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        real = self.keys[slot] == h[maybe]
        places, slots = maybe[real], slot[real]
        total = np.cumsum(self.count[slots])
        i = 0
        while i < len(places):
            done = int(total[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(total, done + HITS, "right")))
            place, slot = places[i:j], slots[i:j]
            n = self.count[slot]
            base = np.repeat(self.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield np.repeat(place, n), self.item[base], self.at[base]
            i = j

    def bands(self, text: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (text, item, band) with as many shared q-grams as the lemma asks for.

        Counts of a band are added up over blocks of hits and given up once the text has moved beyond it, so what is held is
        bounded by the items near one place.
        """
        # (text, item, band, place in item) as one number; bands begin below 0 where an item would begin before the texts.
        most, first = int(self.size.max(initial=0)) + 1, int((self.size // (self.k + 1)).max(initial=0)) + 2
        bands = len(text) + first + 2
        if (len(ends) * len(self.ids) * bands) * most >= 1 << 63:
            raise ValueError("too many items in a block for texts of this length")
        held, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def parted(keys):
            return keys // bands // len(self.ids), keys // bands % len(self.ids), keys % bands - first

        for place, item, at in self.hits(gram_hashes(text, self.q)):
            doc = np.searchsorted(ends, place, "right") - 1
            inside = place + self.q <= ends[doc + 1]
            now = int(place[-1])
            place, item, at, doc = place[inside], item[inside], at[inside], doc[inside]
            # Each hit counts in its own half band and joined to the one before: bands of 2(k+1) that overlap by k+1.
            key = ((doc * len(self.ids) + item) * bands + (place - at) // (self.k[item] + 1) + first) * most + at
            keys = np.sort(np.concatenate([key, key - most]))
            keys = keys[np.r_[True, keys[1:] != keys[:-1]]] // most if len(keys) else keys
            keys = np.concatenate([held, keys])
            more = np.concatenate([counts, np.ones(len(keys) - len(held), np.int64)])
            order = np.argsort(keys, kind="stable")  # two ascending runs
            keys, more = keys[order], more[order]
            head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
            held, counts = keys[head], np.add.reduceat(more, head) if len(head) else more
            _, item, band = parted(held)
            passed = (band + 2) * (self.k[item] + 1) + self.size[item] < now
            enough = passed & (counts >= self.need[item])
            yield np.stack(parted(held[enough]), 1)
            held, counts = held[~passed], counts[~passed]
        yield np.stack(parted(held[counts >= self.need[parted(held)[1]]]), 1) if len(held) else np.empty((0, 3), np.int64)

    def matches(self, text: np.ndarray, ends: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """Matches by text number; text: several normalised texts in one array, cut at ends. Places are in each text."""
        out: dict[int, set] = {}
        known: dict[tuple, list] = {}
        for rows in self.bands(text, ends):
            # Items held against one place together, in the order of their texts: those that begin alike share their rows.
            k = self.k[rows[:, 1]]
            rows, k = (x[np.lexsort((self.turn[rows[:, 1]], k, rows[:, 2], rows[:, 0]))] for x in (rows, k))
            cuts = np.flatnonzero(np.r_[True, (rows[1:, [0, 2]] != rows[:-1, [0, 2]]).any(1) | (k[1:] != k[:-1])]) if len(rows) else []
            for a, b in zip(cuts, [*cuts[1:], len(rows)]):
                d, band, budget, items = int(rows[a, 0]), int(rows[a, 2]), int(k[a]), rows[a:b, 1]
                low, width = band * (budget + 1) - budget, 4 * budget + 3
                first, last = int(ends[d]), int(ends[d + 1])
                high = low + width + int(self.size[items].max())
                # Outside the text nothing matches.
                region = np.concatenate([np.full(max(0, first - low), 0xFFFFFFFF, np.uint32), text[max(first, low):min(last, high)]])
                same = (budget, width, region.tobytes(), items.tobytes())  # a text that repeats itself asks the same again
                if same not in known:
                    if len(known) > 256:
                        known.clear()
                    known[same] = self._aligned(region, width, budget, items)
                for i, edits, end in known[same]:
                    stop = min(last, max(first, low + end)) - first
                    points = self.points[i]
                    start = place_of(points, text[first:last], stop, edits)
                    out.setdefault(d, set()).add((self.ids[i], start, stop, edits))
        return {d: sorted(m, key=lambda x: (x[0] is None, x)) for d, m in out.items()}

    def _aligned(self, region: np.ndarray, width: int, k: int, items: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, edits, end in the region) of the items that have a place in the band."""
        band, out = Band(region, width, k), []
        for i in items.tolist():
            if band.align(self.points[i]):
                costs = band.costs()
                p = int(costs.argmin())
                out.append((i, int(costs[p]), len(self.points[i]) + p))
        return out


def slices(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, code points, ends) of runs of normalised texts of about SLICE characters."""
    run, size, first = [], 0, 0
    for i, t in enumerate(texts):
        run.append(normalized(t or ""))
        size += len(run[-1])
        if size >= SLICE or i == len(texts) - 1:
            yield first, codes("".join(run)), np.cumsum([0, *map(len, run)])
            run, size, first = [], 0, i + 1


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(f"`{item_col}`").cast("long"), F.col(f"`{text_col}`")).where(F.col(f"`{text_col}`").isNotNull()).toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 out: str = "_leaks", q: int = Q, rate: float = ERROR_RATE) -> DataFrame:
    """docs with one more column: the matches of each row's text. No shuffle; one pass per block of the benchmark."""
    result = docs.withColumn(out, F.array().cast(MATCHES))
    for block in blocks(benchmark, item_col, item_text):
        result = _with_block(result, block, text_col, out, q, rate)
    return result


def _with_block(docs: DataFrame, block: list, text_col: str, out: str, q: int, rate: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    made: dict[int, Index] = {}

    @F.pandas_udf(MATCHES)
    def leaks(texts):
        if 0 not in made:
            made[0] = Index(shared.value, q, rate)
        rows: list = [[] for _ in range(len(texts))]
        for first, points, ends in slices(texts.tolist()):
            for d, found in made[0].matches(points, ends).items():
                rows[first + d] = [{"item_id": i, "start": s, "end": e, "edits": x} for i, s, e, x in found]
        return pd.Series(rows)

    return docs.withColumn(out, F.concat(F.col(out), leaks(F.col(f"`{text_col}`"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the rows that hold a whole item of the benchmark (within its edit budget); all columns as they are."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return with_matches(rows, benchmark).where(F.size("_leaks") == 0).select("row.*")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document with what it shares with the benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", (F.size("_leaks") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform("_leaks", lambda m: m.item_id))).alias("item_ids"),
        F.array_min(F.transform("_leaks", lambda m: m.edits)).alias("least_edits"))
