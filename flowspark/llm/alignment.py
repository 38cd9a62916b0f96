"""Cross-tokenizer alignment by merge-path partitioning of two token streams.

A text's A tokens and B tokens both cover its bytes. Where an A token and a B token end at the same byte the streams can be
cut; between two such cuts lies a group, and within it every A-B pair whose bytes overlap is a link. Both come from merging
the two sorted lists of ends. The merge path is cut by diagonals: one binary search for each of them says how many ends of
either list come before, so the pieces between diagonals are independent and equal in work, whatever the texts are like
(`merge_path` walks all pieces of a slice side by side). A piece emits its overlaps and the groups that close in it; a
group that reaches over pieces is stitched by the running number of closed groups.

Texts are tokenized where they lie, in slices of a quarter megabyte. A longer text is cut before single blanks between
printable ASCII characters, where neither tokenizer has a token across (A splits there by its pattern; B's vocabulary is
looked through for such pieces, and a text is not cut if it has one).

Corpus-wide counts of id pairs are summed in the tasks first. The most frequent pairs (at most `FREQUENT`, 16 bytes each)
go to all tasks, which settle them where the documents' pairs lie; a rarer pair is too rare to be a hot key, and only those
travel as rows to a join. A B id's highest count is one row for each id of the vocabulary.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from blank + text, have no tokens: zeros,
and '' for the digest. Null ids are kept; repeated rows are documents of their own and count each. An empty table gives an
empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.words import SLICE, texts
from flowspark.session import materialize

#: Ends that a piece of the merge path covers.
WORK = 64
#: Pairs of ids that go to all tasks, at most.
FREQUENT = 500_000
#: Links summed together inside a task.
LOOK = 2_000_000
#: The pattern by which byte-level BPE files of this kind split text; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Bytes:
    """Byte strings of all ids of a vocabulary in one array."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.at[ids] - end + size, size) + np.arange(end[-1] if len(end) else 0)]


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A: a byte-level BPE file. Texts of Latin letters go by its ranks, others to the file's own library; ids are the same."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
        entries = [b""] * (max(self.whole.get_vocab(with_added_tokens=True).values()) + 1)
        for token, i in vocab.items():
            entries[i] = token
        self.bytes = Bytes(entries)
        self.fast = self._ranked(vocab, model["merges"], letters)

    @staticmethod
    def _ranked(vocab: dict, merges: list, letters: dict):
        """An encoder by ranks, where ids are ranks: every merge makes the next id."""
        import tiktoken

        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        ids = [vocab[bytes(letters[c] for c in token)] for token in made]
        ranks = {token: i for token, i in vocab.items() if len(token) == 1 or i >= 256}
        kept = set(ids) | {i for token, i in vocab.items() if len(token) == 1}
        if ids != sorted(ids) or len(set(ids)) < len(ids):
            return None
        ranks = {token: i for token, i in ranks.items() if i in kept}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str, latin: bool) -> np.ndarray:
        if self.fast is not None and latin:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """B: a sentencepiece file, which puts a blank before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = Bytes([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                            for i, n in enumerate(names)])
        #: whether no piece goes on over a blank, so that texts can be cut before one
        self.cuts = not any("▁" in n.lstrip("▁") for n in names)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of two lists of ends over the same bytes (both ascend and have the same last end).

    (A token, B token, group) of every overlapping pair, along the merge path.
    """
    na, nb = len(a), len(b)
    none = np.empty(0, np.int64)
    if not na or not nb:
        return none, none, none
    # The path takes all ends in order, an A end before an equal B end. Diagonal d is crossed after d ends.
    d = np.arange(0, na + nb, work)
    low, high = np.maximum(0, d - nb), np.minimum(d, na)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        first = a[np.minimum(mid, na - 1)] <= b[np.clip(d - 1 - mid, 0, nb - 1)]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    i, j = low, d - low
    past = np.int64(1 << 62)
    ea, eb = np.append(a, past), np.append(b, past)
    sa, sb = np.concatenate([[0], a]), np.concatenate([[0], b])
    lanes = len(d)
    at_a, at_b = np.empty((work, lanes), np.int64), np.empty((work, lanes), np.int64)
    meets, closes = np.zeros((work, lanes), bool), np.zeros((work, lanes), bool)
    for step in range(work):
        live = i + j < na + nb
        x, y = ea[i], eb[j]
        at_a[step], at_b[step] = i, j
        # overlap: both have begun before the other ends; past the last token of a side nothing begins
        meets[step] = live & (sa[i] < y) & (sb[j] < x) & (i < na) & (j < nb)
        takes_a = x <= y
        closes[step] = live & ~takes_a & (sa[i] == y)
        i, j = i + (live & takes_a), j + (live & ~takes_a)
    # Groups closed before each step: within its piece, and in the pieces before (the stitches).
    before = np.cumsum(closes, axis=0) - closes
    stitched = np.concatenate([[0], np.cumsum(closes.sum(0))[:-1]])
    group = before + stitched
    keep = meets.T
    return at_a.T[keep], at_b.T[keep], group.T[keep]


class Aligner:
    """Both tokenizers and what a worker needs to write ids as text."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.span = len(self.b.bytes.size)
        most = max(len(self.a.bytes.size), self.span)
        self.names = Bytes([b"%d," % i for i in range(most)])

    def aligned(self, pieces: list[str]) -> dict:
        """Tokens, groups and links of some texts: each a blank and what is given. Texts that are not covered have none."""
        raw = [t.encode() for t in pieces]
        latin = [not any(c >= 0xC9 for c in r) if not r.isascii() else True for r in raw]
        a = [self.a.ids(" " + t, plain) for t, plain in zip(pieces, latin, strict=True)]
        b = [np.array(x, np.int64) for x in self.b.ids(pieces)]
        for i, r in enumerate(raw):
            if not self._covers(a[i], b[i], b" " + r):
                a[i] = b[i] = np.empty(0, np.int64)
        cut_a, cut_b = np.cumsum([0, *map(len, a)]), np.cumsum([0, *map(len, b)])
        a, b = np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b])
        i, j, group = merge_path(np.cumsum(self.a.bytes.size[a]), np.cumsum(self.b.bytes.size[b]))
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[i], group_b[j] = group, group
        return {"a": a, "b": b, "cut_a": cut_a, "cut_b": cut_b, "group_a": group_a, "group_b": group_b, "link_a": i, "link_b": j}

    def _covers(self, a: np.ndarray, b: np.ndarray, text: bytes) -> bool:
        whole = np.frombuffer(text, np.uint8)
        for ids, table in ((a, self.a.bytes), (b, self.b.bytes)):
            if table.size[ids].sum() != len(whole) or not np.array_equal(table.joined(ids), whole):
                return False
        return True

    def written(self, got: dict) -> tuple[bytes, np.ndarray]:
        """Groups as `a1,a2|b1;a3|b2,b3;` of all texts, and where each text's part ends (its last sign is one too many)."""
        a, b, ga, gb = got["a"], got["b"], got["group_a"], got["group_b"]
        n = len(a) + len(b)
        ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        # A group's A ids come before its B ids.
        at_a = np.arange(len(a)) + np.searchsorted(gb, ga, "left")
        at_b = np.arange(len(b)) + np.searchsorted(ga, gb, "right")
        ids[at_a], ids[at_b] = a, b
        mark[at_a[np.flatnonzero(np.append(ga[1:] != ga[:-1], True))] if len(a) else []] = ord("|")
        mark[at_b[np.flatnonzero(np.append(gb[1:] != gb[:-1], True))] if len(b) else []] = ord(";")
        out = self.names.joined(ids)
        end = np.concatenate([[0], np.cumsum(self.names.size[ids])])
        out[end[1:] - 1] = mark
        return out.tobytes(), end[got["cut_a"] + got["cut_b"]]


_made: dict[tuple, Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """This worker's aligner of two files."""
    if (a, b) not in _made:
        _made.clear()
        _made[a, b] = Aligner(a, b)
    return _made[a, b]


def parts(data: np.ndarray, size: int = SLICE) -> Iterator[str]:
    """A text in parts of about size bytes, cut at single blanks between printable ASCII characters (the blank left out)."""
    at = 0
    while len(data) - at > size:
        cut, low = -1, at + size
        while cut < 0 and low < len(data) - 2:
            some = data[low - 1:min(len(data), low + size + 1)]
            printable = (some > 0x20) & (some < 0x7F)
            fits = np.flatnonzero((some[1:-1] == 0x20) & printable[:-2] & printable[2:])
            cut = low + int(fits[0]) if len(fits) else -1
            low += size
        if cut < 0:
            break
        yield data[at:cut].tobytes().decode()
        at = cut + 1
    yield data[at:].tobytes().decode()


def batches(column: pa.Array, worker: Aligner, size: int = SLICE) -> Iterator[tuple[int, int, bool, bool, dict]]:
    """(first row, end row, first part, last part, tokens) over a column: runs of small texts, and the parts of long ones."""
    data, ends = texts(column)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
        if ends[j] - ends[i] <= size or not worker.b.cuts:
            raw = [data[ends[r]:ends[r + 1]].tobytes().decode() for r in range(i, j)]
            yield i, j, True, True, worker.aligned(raw)
        else:
            held, first = None, True
            for part in parts(data[ends[i]:ends[j]], size):
                if held is not None:
                    yield i, j, first, False, worker.aligned([held])
                    first = False
                held = part
            yield i, j, first, True, worker.aligned([held])
        i = j


def _digest_rows(batch: pa.RecordBatch, worker: Aligner, held: list) -> Iterator[list]:
    """Per document: counts, digest of the groups, distinct pairs and their links. held: gets the pairs of each slice."""
    for i, j, first, last, got in batches(batch.column(1), worker):
        rows = j - i
        key = got["a"][got["link_a"]] * worker.span + got["b"][got["link_b"]]
        owner = np.searchsorted(got["cut_a"], got["link_a"], "right") - 1
        told, ends = worker.written(got)
        groups = np.zeros(len(got["a"]) + 1, np.int64)  # groups that end before each A token
        if len(got["a"]):
            np.cumsum(np.append(got["group_a"][1:] != got["group_a"][:-1], True), out=groups[1:])
        if first and last:
            some, count = np.unique(owner * (1 << 40) + key, return_counts=True)
            cuts = np.searchsorted(some, np.arange(rows + 1) << 40)
            some &= (1 << 40) - 1
            links = np.bincount(owner, minlength=rows)
            n_a, n_b = np.diff(got["cut_a"]), np.diff(got["cut_b"])
            n_groups = np.diff(groups[got["cut_a"]])
            for r in range(rows):
                sha = hashlib.sha256(told[ends[r]:ends[r + 1] - 1]).hexdigest() if n_a[r] else ""
                p = slice(cuts[r], cuts[r + 1])
                yield [i + r, n_a[r], n_b[r], n_groups[r], links[r], sha, some[p], count[p]]
            held.append((some, count))
            continue
        if first:
            sha, sums, pairs, whole = hashlib.sha256(), np.zeros(4, np.int64), [], True
        whole &= bool(len(got["a"]))  # a part that is not covered leaves the document without tokens
        sums += [len(got["a"]), len(got["b"]), groups[-1], len(key)]
        sha.update(told if not last else told[:-1])
        pairs.append(np.unique(key, return_counts=True))
        if len(pairs) > 64 or last:
            pairs = [_summed(pairs)]
        if last:
            if whole:
                yield [i, *sums, sha.hexdigest(), *pairs[0]]
                held.append(pairs[0])
            else:
                none = np.empty(0, np.int64)
                yield [i, 0, 0, 0, 0, "", none, none]


def _summed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate([k for k, _ in pairs]), return_inverse=True)
    return key, np.bincount(back, np.concatenate([n for _, n in pairs]), len(key)).astype(np.int64)


TOLD = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "a array<int>, b array<int>, n array<int>, key_a int, key_b int, key_n long")


def _told(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row for every document, and rows (key_a, key_b, key_n) with the links of id pairs, summed over parts of a task."""
    def lists(arrays: list[np.ndarray]) -> pa.Array:
        cuts = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)))

    def counted(pairs, span):
        key, n = _summed(pairs)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(key), t) for t in (*[pa.int64()] * 5, pa.string(), *[pa.list_(pa.int32())] * 3)]
            + [pa.array((key // span).astype(np.int32)), pa.array((key % span).astype(np.int32)), pa.array(n)], names=NAMES)

    def rows(batch, some, span):
        n = len(some)
        columns = list(zip(*some, strict=True))
        keys = [np.asarray(k) for k in columns[6]]
        # by B id first: long runs of equal values
        turns = [np.lexsort((k // span, k % span)) for k in keys]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.string()),
             lists([(k // span)[t] for k, t in zip(keys, turns, strict=True)]), lists([(k % span)[t] for k, t in zip(keys, turns, strict=True)]),
             lists([c[t] for c, t in zip(columns[7], turns, strict=True)]),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=NAMES)

    def run(source):
        worker, held = aligner(a, b), []
        for batch in source:
            some, size = [], 0
            for row in _digest_rows(batch, worker, held):
                some.append(row)
                size += len(row[6])
                if size > 500_000:
                    yield rows(batch, some, worker.span)
                    some, size = [], 0
                if sum(len(k) for k, _ in held) > LOOK:
                    held[:] = [_summed(held)]
                    if len(held[0][0]) > LOOK // 2:
                        yield counted(held, worker.span)
                        held.clear()
            if some:
                yield rows(batch, some, worker.span)
        if held:
            yield counted(held, worker.span)

    return docs.mapInArrow(run, TOLD)


NAMES = [c.split()[0] for c in TOLD.split(", ")]


def _settled(docs: DataFrame, frequent: tuple) -> DataFrame:
    """docs with n_best and count_sum over their frequent pairs, and the others as `rest`."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(source):
        key, count, best = shared.value
        for batch in source:
            got = [batch.column(c) for c in ("a", "b", "n")]
            ends = np.concatenate([[0], np.cumsum(got[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            a, b, n = (c.flatten().to_numpy().astype(np.int64) for c in got)
            mine = (a << 32) + b
            at = np.minimum(np.searchsorted(key, mine), max(len(key) - 1, 0))
            known = key[at] == mine if len(key) else np.zeros(len(mine), bool)
            times = np.where(known, n, 0)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in
                    ((times * best[at], times * count[at]) if len(key) else (times, times))]
            rest = np.flatnonzero(~known)
            cuts = pa.array(np.searchsorted(rest, ends).astype(np.int32))
            other = pa.StructArray.from_arrays([pa.array(x[rest].astype(np.int32)) for x in (a, b, n)], ["a", "b", "n"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", *NAMES[:6])), *(pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums),
                 pa.ListArray.from_arrays(cuts, other)], names=["rid", *NAMES[:6], "n_best", "count_sum", "rest"])

    return docs.mapInArrow(run, "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "n_best long, count_sum long, rest array<struct<a:int,b:int,n:int>>")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def align(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per group of each document: doc_id, group_no, start, end (bytes of blank + text), a_ids, b_ids. No shuffle."""
    def run(source):
        worker = aligner(a, b)
        for batch in source:
            whole: set[int] = set()
            for i, _, first, last, got in batches(batch.column(1), worker):
                if first and not last:  # a long text: all its parts have to be covered before any row is given
                    whole.discard(i)
                    part = batch.column(1).slice(i, 1)
                    if all(len(g["a"]) for *_, g in batches(part, worker)):
                        whole.add(i)
                    at, number = 0, 0
                if first and last:
                    doc = np.searchsorted(got["cut_a"], np.arange(len(got["a"])), "right") - 1
                elif i in whole:
                    doc = np.zeros(len(got["a"]), np.int64)
                else:
                    continue
                head_a = np.flatnonzero(np.append(True, got["group_a"][1:] != got["group_a"][:-1])) if len(doc) else np.empty(0, np.int64)
                head_b = np.flatnonzero(np.append(True, got["group_b"][1:] != got["group_b"][:-1])) if len(doc) else np.empty(0, np.int64)
                end = np.cumsum(worker.a.bytes.size[got["a"]])
                start = np.append(0, end)[head_a]
                stop = np.append(start[1:], end[-1]) if len(end) else start
                own = doc[head_a]
                begin = np.searchsorted(own, own)
                base, no = (at, number) if not (first and last) else (-start[begin] if len(own) else start, -begin)
                cut = lambda x, heads: pa.ListArray.from_arrays(
                    pa.array(np.append(heads, len(x)).astype(np.int32)), pa.array(x.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own + i)), pa.array(np.arange(len(own)) + no), pa.array(start + base), pa.array(stop + base),
                     cut(got["a"], head_a), cut(got["b"], head_b)], names=["doc_id", "group_no", "start", "end", "a_ids", "b_ids"])
                if not (first and last):
                    at, number = at + int(end[-1]), number + len(own)

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, group_no long, start long, end long, a_ids array<int>, b_ids array<int>")


def alignment_digests(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    told = materialize(_told(_source(docs, id_col, text_col), a, b).withColumn("rid", F.monotonically_increasing_id()), "alignments")
    counts = told.where("key_n IS NOT NULL").groupBy("key_a", "key_b").agg(F.sum("key_n").alias("count"))
    counts = materialize(counts, "pair_counts")
    # One row per B id: the vocabulary bounds it.
    most = counts.groupBy("key_b").agg(F.max("count").alias("most"))
    ranked = counts.join(F.broadcast(most), "key_b").select("key_a", "key_b", "count", (F.col("count") == F.col("most")).alias("best"))
    top = ranked.orderBy(F.col("count").desc(), "key_a", "key_b").limit(FREQUENT).toArrow()
    key = (top.column("key_a").to_numpy().astype(np.int64) << 32) + top.column("key_b").to_numpy()
    order = np.argsort(key)
    frequent = (key[order], top.column("count").to_numpy()[order], top.column("best").to_numpy()[order])

    settled = _settled(told.where("key_n IS NULL"), frequent)
    settled = materialize(settled, "settled")
    rest = settled.select("rid", F.explode("rest").alias("p")).select("rid", F.col("p.a").alias("key_a"), F.col("p.b").alias("key_b"), F.col("p.n").alias("n"))
    more = rest.join(ranked, ["key_a", "key_b"]).groupBy("rid").agg(
        F.sum(F.col("n") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("n") * F.col("count")).alias("_sum"))
    zero = F.lit(0).cast("long")
    return settled.join(more, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", zero)).alias("count_sum"), "groups_sha256")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment_digests(docs, files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"))
