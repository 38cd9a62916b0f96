"""Jaccard self-join of documents over word n-grams by index lists, skipping by set relations.

1. Every text becomes its set of distinct n-grams (64-bit hashes). Equal sets are one class; only classes are joined.
2. Two sets at or above the threshold share an n-gram within their prefixes (the first n - ceil(t n) + 1 in a common
   order), so only prefixes are shuffled into index lists. The order puts n-grams that are frequent in some task last
   (a list of at most `FREQUENT`), so frequent lines stay out of prefixes unless a set has little else.
3. All classes of an index list meet under the list's least class, its pivot: lists with the same members fall together.
   Large groups are dealt into blocks, and pairs of blocks are tasks.
4. A group first compares parity bitmaps (half a byte per n-gram; differing bits never exceed the sets' difference, so
   no link is lost), walking members by size and skipping those whose size rules a link out. A pair counts only in its
   least common pivot. Members left with a partner bring their whole sets.
5. Exact intersections: sets are walked in an order that puts similar ones next to each other; when a set differs
   little from the one before, its counts against all members are derived from those by the few n-grams that differ.
   A group returns one row per member (its links) and a spanning forest of the links, never all pairs.
6. Components of the forest's links give each document the smallest doc_id it can reach.

Defined results: null texts and texts without words have an empty set and link with nothing; texts with fewer words than
n have their whole sequence as one n-gram. Null ids take part in links, but a component's id is the least id that is not
null (null if it has none). Repeated rows are rows of their own. An empty table gives an empty table. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.components import components
from flowspark.llm.words import LOWER, gram_hashes, mixed, range_hashes, slices, span_hashes, spans
from flowspark.session import materialize

WORDS = 5
#: The threshold as a fraction of integers: links hold when DEN * intersection >= NUM * union.
NUM, DEN = 80, 100
#: n-grams moved to the end of the order, at most; they only steer which n-grams are indexed.
FREQUENT = 100_000
FREQUENT_FROM = 64
#: Hashes that several sets share, looked up in the tasks up to this many (none is likely, whatever the corpus).
TWINS = 10_000
#: Members of a group in one task; larger groups go as pairs of blocks.
BLOCK = 4096
#: Texts named by fewer rows than this are fetched by a broadcast of their ids, by a shuffled join beyond it.
BROADCAST_ROWS = 200_000
#: n-grams looked at together for frequent ones.
LOOK = 1_000_000


def shingles(data: np.ndarray, ends: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of each text, one text after the other, and the cuts between texts."""
    low = LOWER[data]
    first, last = spans(low, ends)
    h = span_hashes(low, first, last)
    cuts = np.searchsorted(first, ends)
    n = len(ends) - 1
    owner = np.repeat(np.arange(n), np.diff(cuts))
    gram = gram_hashes(h, words)
    whole = owner[words - 1:] == owner[:len(gram)] if len(gram) else np.empty(0, bool)
    short = np.flatnonzero((np.diff(cuts) > 0) & (np.diff(cuts) < words))
    gram = np.concatenate([gram[whole], range_hashes(h, cuts[short], cuts[short + 1]) if len(short) else np.empty(0, np.uint64)])
    owner = np.concatenate([owner[:len(whole)][whole], short])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])] if len(gram) else np.empty(0, bool)
    gram, owner = gram[fresh], owner[fresh]
    return gram, np.searchsorted(owner, np.arange(n + 1))


def digests(gram: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, by sums over its members."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(len(gram) + 1, np.uint64)
        np.cumsum(mixed(gram * np.uint64(salt)), out=total[1:])
        out.append(mixed(total[cuts[1:]] - total[cuts[:-1]] + np.diff(cuts).astype(np.uint64)))
    return out[0], out[1]


def width(n: int) -> int:
    """Bits of a set's parity bitmap: a power of two, at least four for each member."""
    return 1 << max(6, (4 * n - 1).bit_length())


def parity(gram: np.ndarray) -> bytes:
    b = width(len(gram))
    odd = np.bincount((gram >> np.uint64(7)).astype(np.int64) & (b - 1), minlength=b) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


SETS = "doc_id long, h long, d1 long, d2 long, n long, bits binary, gram long, docs long"


def _set_rows(docs: DataFrame, words: int) -> DataFrame:
    """A row for every document's set, and rows (gram, docs) for n-grams that several sets of a run share."""
    def frequent(grams: list[np.ndarray]):
        key, count = np.unique(np.concatenate(grams), return_counts=True)
        some = count >= 3
        return pa.RecordBatch.from_arrays(
            [pa.nulls(some.sum(), t) for t in (*[pa.int64()] * 5, pa.binary())]
            + [pa.array(key[some].view(np.int64)), pa.array(count[some], pa.int64())],
            names=["doc_id", "h", "d1", "d2", "n", "bits", "gram", "docs"])

    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for i, j, data, ends in slices(batch.column(1)):
                gram, cuts = shingles(data, ends, words)
                d1, d2 = digests(gram, cuts)
                rows = j - i
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, rows), batch.column(2).slice(i, rows), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array(np.diff(cuts), pa.int64()),
                     pa.array([parity(gram[cuts[r]:cuts[r + 1]]) for r in range(rows)], pa.binary()),
                     pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())],
                    names=["doc_id", "h", "d1", "d2", "n", "bits", "gram", "docs"])
                for r in range(rows):
                    if d1[r] not in seen:
                        seen.add(d1[r])
                        held.append(gram[cuts[r]:cuts[r + 1]])
                        size += len(held[-1])
                if size >= LOOK:
                    yield frequent(held)
                    held, size, seen = [], 0, set()
        if held:
            yield frequent(held)

    return docs.mapInArrow(run, SETS)


class Order:
    """The common order of n-grams: by hash, frequent ones last and the most frequent at the very end."""

    def __init__(self, frequent: np.ndarray):
        """frequent: n-grams, least frequent first."""
        order = np.argsort(frequent)
        self.keys, self.rank = frequent[order], order.astype(np.uint64)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def places(self, gram: np.ndarray) -> np.ndarray:
        out = gram >> np.uint64(1)
        maybe = np.flatnonzero(self.bits[(gram >> np.uint64(44)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, gram[maybe]), len(self.keys) - 1)
            real = self.keys[at] == gram[maybe]
            out[maybe[real]] = self.rank[at[real]] + np.uint64(1 << 63)
        return out


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-NUM * n // DEN) + 1


def _named(rows: DataFrame, twins: DataFrame) -> DataFrame:
    """rows (d1, d2) with sid: the first hash, or one of both where different sets share the first."""
    told = twins.select("d1", F.lit(True).alias("_twin"))
    return rows.drop("sid").join(told, "d1", "left").withColumn("sid", F.when(F.col("_twin"), F.col("d1").bitwiseXOR(F.col("d2"))).otherwise(F.col("d1"))).drop("_twin")


def _prefixes(docs: DataFrame, frequent: np.ndarray, renamed: np.ndarray | None, words: int) -> DataFrame:
    """(gram, sid, d1, d2, hot) of every set's prefix; sid only if `renamed` says which sets share a hash, else d1 and d2."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, renamed))

    def run(batches):
        order = Order(shared.value[0])
        other = shared.value[1]
        for batch in batches:
            for _, _, data, ends in slices(batch.column(0)):
                gram, cuts = shingles(data, ends, words)
                d1, d2 = digests(gram, cuts)
                sid = np.where(np.isin(d1, other), d1 ^ d2, d1) if other is not None else d1 ^ (d2 * np.uint64(3))
                _, one = np.unique(sid, return_index=True)
                keep = np.zeros(len(sid), bool)
                keep[one] = True
                n = np.diff(cuts)
                owner = np.repeat(np.arange(len(n)), n)
                place = order.places(gram)
                if (place >= np.uint64(1 << 63)).any():
                    turn = np.lexsort((place, owner))
                    gram, place = gram[turn], place[turn]
                pos = np.arange(len(gram)) - cuts[:-1][owner]
                take = (pos < prefix_length(n)[owner]) & keep[owner]
                mine = owner[take]
                none = pa.nulls(len(mine), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[take].view(np.int64)), pa.array(place[take] >= np.uint64(1 << 63)),
                     *((pa.array(sid[mine].view(np.int64)), none, none) if other is not None
                       else (none, pa.array(d1[mine].view(np.int64)), pa.array(d2[mine].view(np.int64))))],
                    names=["gram", "hot", "sid", "d1", "d2"])

    return docs.mapInArrow(run, "gram long, hot boolean, sid long, d1 long, d2 long")


def _memberships(prefixes: DataFrame) -> DataFrame:
    """Distinct (pivot, sid) over index lists of two sets and more."""
    plain = prefixes.where("NOT hot")
    w = Window.partitionBy("gram")
    plain = plain.select("sid", F.min("sid").over(w).alias("pivot"), F.max("sid").over(w).alias("_most")).where("pivot < _most")
    hot = prefixes.where("hot")
    # One row per frequent n-gram: bounded by FREQUENT, whatever the corpus.
    least = hot.groupBy("gram").agg(F.min("sid").alias("pivot"), F.max("sid").alias("_most")).where("pivot < _most")
    hot = hot.join(F.broadcast(least.select("gram", "pivot")), "gram")
    return plain.select("pivot", "sid").unionByName(hot.select("pivot", "sid")).distinct()


def _dealt(members: DataFrame) -> DataFrame:
    """members with their block and the pairs of blocks they take part in (a <= b)."""
    sizes = materialize(members.groupBy("pivot").agg(F.count(F.lit(1)).alias("_k")), "sizes")
    many = F.ceil(F.col("_k") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("sid"), many).cast("int")
    return (
        members.join(sizes, "pivot").withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
        .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")).drop("other", "_k")
    )


def _relevant(pivots: list, block: np.ndarray, a: int, b: int, pivot: int):
    """Function from a member to a mask of partners whose pair counts in this group and pair of blocks."""
    has: dict[int, np.ndarray] = {}
    for m, own in enumerate(pivots):
        for p in own:
            if p < pivot:
                has.setdefault(p, np.zeros(len(pivots), bool))[m] = True

    def mask(m: int) -> np.ndarray:
        out = np.ones(len(pivots), bool) if a == b else block != block[m]
        for p in pivots[m]:
            if p < pivot:
                out &= ~has[p]
        out[m] = False
        return out

    return mask


def near_by_bitmap(n: np.ndarray, bits: list[bytes], mask) -> np.ndarray:
    """Which members have a partner that bitmaps do not rule out. n ascends."""
    k = len(n)
    sizes = np.array([len(x) * 8 for x in bits])
    levels: dict[int, tuple[int, np.ndarray]] = {}
    for w in np.unique(sizes).tolist():
        start = int(np.searchsorted(sizes, w))
        rows = np.zeros((k - start, w // 64), np.uint64)
        for r in range(start, k):
            words = np.frombuffer(bits[r], np.uint64)
            rows[r - start] = np.bitwise_xor.reduce(words.reshape(-1, w // 64), axis=0)
        levels[w] = (start, rows)
    left = np.zeros(k, bool)
    for i in range(k):
        high = int(np.searchsorted(n, n[i] * DEN // NUM, "right"))
        if high <= i + 1:
            continue
        start, rows = levels[int(sizes[i])]
        some = np.flatnonzero(mask(i)[i + 1:high]) + i + 1
        if not len(some):
            continue
        apart = np.bitwise_count(rows[some - start] ^ rows[i - start]).sum(1, dtype=np.int64)
        # difference D and sizes a, b at the threshold: DEN * (a + b - D) >= NUM * (a + b + D)
        near = some[(DEN + NUM) * apart <= (DEN - NUM) * (n[i] + n[some])]
        if len(near):
            left[i] = True
            left[near] = True
    return left


def _first_pass(table: pa.Table) -> pa.Table:
    table = table.sort_by([("n", "ascending"), ("sid", "ascending")])
    pivot, a, b = (table.column(c)[0].as_py() for c in ("pivot", "a", "b"))
    mask = _relevant(table.column("pivots").to_pylist(), table.column("block").to_numpy(), a, b, pivot)
    left = near_by_bitmap(table.column("n").to_numpy(), table.column("bits").to_pylist(), mask)
    return table.select(["pivot", "a", "b", "block", "sid"]).filter(pa.array(left))


def links_of(sets: list[np.ndarray], weight: np.ndarray, mask) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Summed weight of each member's links that count, and links that span the linked members.

    Counts of a set against all are taken from the index lists of its n-grams, or derived from the set before.
    """
    k = len(sets)
    order = sorted(range(k), key=lambda m: sets[m][:4].tolist())
    gram = np.concatenate(sets)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    by = np.argsort(gram, kind="stable")
    gram, owner = gram[by], owner[by]
    n = np.array([len(s) for s in sets])

    def counts(some: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(gram, some, "left"), np.searchsorted(gram, some, "right")
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(owner[at], minlength=k)

    total, links, root = np.zeros(k, np.int64), [], list(range(k))

    def find(m: int) -> int:
        while root[m] != m:
            root[m] = root[root[m]]
            m = root[m]
        return m

    before, have = None, None
    for m in order:
        own = sets[m]
        if before is not None:
            new, gone = np.setdiff1d(own, before, assume_unique=True), np.setdiff1d(before, own, assume_unique=True)
        if before is not None and len(new) + len(gone) < len(own) // 2:
            have = have + counts(new) - counts(gone)
        else:
            have = counts(own)
        before = own
        hit = np.flatnonzero((DEN * have >= NUM * (n[m] + n - have)) & mask(m))
        total[m] = weight[hit].sum()
        for o in hit.tolist():
            x, y = find(m), find(o)
            if x != y:
                root[x] = y
                links.append((m, o))
    return total, links


def _second_pass(table: pa.Table) -> pa.Table:
    pivot, a, b = (table.column(c)[0].as_py() for c in ("pivot", "a", "b"))
    _, once = np.unique(table.column("sid").to_numpy(), return_index=True)  # a row may be repeated
    table = table.take(pa.array(once))
    sid = table.column("sid").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
    mask = _relevant(table.column("pivots").to_pylist(), table.column("block").to_numpy(), a, b, pivot)
    total, links = links_of(sets, table.column("weight").to_numpy(), mask)
    u = np.concatenate([sid, sid[[x for x, _ in links]] if links else np.empty(0, np.int64)])
    v = np.concatenate([sid, sid[[y for _, y in links]] if links else np.empty(0, np.int64)])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
                     "links": pa.array(np.r_[total, np.zeros(len(links), np.int64)], pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, n_links (linked rows, itself not counted)."""
    return _judged(docs, id_col, text_col, words).select("doc_id", "n_shingles", "component_id", "n_links")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """docs with one row of each component left, the one with the smallest id; all columns as they are.

    Rows without words stay. Of rows with equal ids and texts in a component one stays.
    """
    judged = materialize(_judged(docs, id_col, text_col, words).where("n_shingles > 0").select("root", *_place()), "judged")
    places = judged.groupBy("root", "_none", "_id", "_h").agg(F.count(F.lit(1)).alias("rows"))
    kept = places.groupBy("root").agg(F.min(F.struct("_none", "_id", "_h")).alias("k"))
    told = materialize(places.join(kept, "root").withColumn("keep", F.col("k") == F.struct("_none", "_id", "_h")), "told")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("h")).select("row", *_place())

    def at(some: DataFrame, how: str, of: DataFrame) -> DataFrame:
        small = some.count() <= BROADCAST_ROWS
        some = some.select("_none", "_id", "_h").distinct()
        return of.join(F.broadcast(some) if small else some, ["_none", "_id", "_h"], how)

    left = at(told.where("NOT keep"), "left_anti", rows)
    repeated = told.where("keep AND rows > 1")
    if not repeated.isEmpty():
        left = at(repeated, "left_anti", left).unionByName(at(repeated, "left_semi", left).dropDuplicates(["_none", "_id", "_h"]))
    return left.select("row.*")


def _judged(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id, n_links and the component's root set of every row."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text"))
    made = materialize(_set_rows(source, words), "sets")
    top = made.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("docs").alias("n")).where(F.col("n") >= FREQUENT_FROM) \
        .orderBy(F.col("n").desc(), "gram").limit(FREQUENT).collect()
    frequent = np.array([r.gram for r in reversed(top)], np.int64).view(np.uint64)

    rows = made.where("gram IS NULL").drop("gram", "docs")
    # Different sets that share a 64-bit hash get their second one as name. Few are looked up where prefixes are made; with
    # more than that, prefixes bring both hashes and are named by a join.
    twins = materialize(rows.groupBy("d1").agg(F.min("d2").alias("x"), F.max("d2").alias("y")).where("x <> y").select("d1"), "twins")
    few = twins.limit(TWINS + 1).collect()
    renamed = np.array([r.d1 for r in few], np.int64).view(np.uint64) if len(few) <= TWINS else None
    if len(few):
        rows = _named(rows, twins)
    else:
        rows = rows.withColumn("sid", F.col("d1"))
    classes = materialize(rows.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct(*_place())).alias("place"), F.count(F.lit(1)).alias("weight"),
        F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("d1").alias("d1"), F.min("d2").alias("d2")), "classes")

    prefixes = _prefixes(source.select("text"), frequent, renamed, words)
    prefixes = materialize((prefixes if renamed is not None else _named(prefixes, twins)).select("gram", "sid", "hot"), "prefixes")
    members = materialize(_memberships(prefixes), "members")
    pivots = members.groupBy("sid").agg(F.sort_array(F.collect_list("pivot")).alias("pivots"))
    about = pivots.join(classes, "sid")
    first = _dealt(members).join(about.select("sid", "pivots", "n", "bits"), "sid") \
        .groupBy("pivot", "a", "b").applyInArrow(_first_pass, "pivot long, a int, b int, block int, sid long")
    left = materialize(first, "left")

    groups = left.groupBy("sid").agg(F.collect_list(F.struct("pivot", "a", "b", "block")).alias("groups"))
    wanted = materialize(groups.join(about, "sid").select("place.*", "sid", "d1", "d2", "weight", "pivots", "groups"), "wanted")
    forest = materialize(_with_sets(source, wanted, words).groupBy("pivot", "a", "b").applyInArrow(
        _second_pass, "u long, v long, links long"), "forest")

    roots = components(forest.select("u", "v"))
    linked = forest.groupBy("u").agg(F.sum("links").alias("links"))
    told = classes.select("sid", "least_id", "weight").join(roots.withColumnRenamed("node", "sid"), "sid", "left") \
        .join(linked.withColumnRenamed("u", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = told.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = told.join(smallest, "root").select("sid", "root", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.select("doc_id", "h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("sid")).alias("sid")) \
        .join(told, "sid", "left").select(
            "doc_id", "h", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "root")


def _place() -> list:
    """Columns that find a row again: its id, null or not, and a hash of its text."""
    return [F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("h").alias("_h")]


def _with_sets(source: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """A row for each group of each wanted class, with the class's whole set, taken from the text of one of its rows."""
    texts = source.select(*_place(), "text")
    if wanted.count() <= BROADCAST_ROWS:  # only keys are broadcast, and only the texts they name are moved
        texts = texts.join(F.broadcast(wanted.select("_none", "_id", "_h").distinct()), ["_none", "_id", "_h"], "left_semi")
    found = texts.join(wanted, ["_none", "_id", "_h"])

    def run(batches):
        for batch in batches:
            table = batch.to_pydict() | {"text": None}
            for i, j, data, ends in slices(batch.column("text")):
                gram, cuts = shingles(data, ends, words)
                d1, d2 = (d.view(np.int64) for d in digests(gram, cuts))
                rows = []
                for r in range(i, j):
                    if d1[r - i] == table["d1"][r] and d2[r - i] == table["d2"][r]:
                        own = gram[cuts[r - i]:cuts[r - i + 1]].tobytes()
                        rows += [(g["pivot"], g["a"], g["b"], g["block"], table["sid"][r], table["weight"][r], table["pivots"][r], own)
                                 for g in table["groups"][r]]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds, strict=True)],
                    names=["pivot", "a", "b", "block", "sid", "weight", "pivots", "grams"])

    return found.mapInArrow(run, "pivot long, a int, b int, block int, sid long, weight long, pivots array<long>, grams binary")


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY x, y),
l AS (
  SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id),
g AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id),
k AS (SELECT x AS doc_id, count(*) AS n_links FROM e GROUP BY x)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(g.root, t.doc_id) AS component_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op7_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "n_links")
