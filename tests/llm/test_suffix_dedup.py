import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowspark.llm import suffix_dedup as op
from flowspark.llm.words import TABLE, range_hashes


def brute(rows, window):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + window] for t in data for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, data, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def texts(seed):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdeé ") for _ in range(200))
    rows = []
    for i in range(30):
        t = "".join(rng.choice("abcdefgé \n"[: rng.choice([1, 2, 10])]) for _ in range(rng.randrange(150)))
        if rng.random() < 0.5:
            a = rng.randrange(100)
            t += passage[a:a + rng.randrange(20, 100)]
        if rows and rng.random() < 0.2:
            t = rng.choice(rows)[1] + t
        rows.append((i if rng.random() < 0.9 else None, t))
    return [*rows, (50, "ab" * 300), (51, None), (52, ""), (53, "é"), rows[0], rows[0]]


@pytest.mark.parametrize(("window", "gram", "hot", "size"), [(40, 8, 4000, 1 << 20), (24, 4, 1, 1 << 20), (40, 8, 4000, 64)])
def test_against_brute_force(make_docs, monkeypatch, window, gram, hot, size):
    monkeypatch.setattr(op, "HOT", hot)
    monkeypatch.setattr(op, "SHARD", 3000)
    rows = texts(window + hot)
    got = op.deduplicated(make_docs(*rows), window, gram, size=size).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in got), key=str) \
        == sorted(brute(rows, window), key=str)


def test_suffix_array_and_search():
    rng = random.Random(2)
    for _ in range(80):
        window = rng.choice([3, 8, 20])
        strings = [bytes(rng.choice(b"ab\0c"[: rng.choice([1, 2, 4])]) for _ in range(rng.randrange(1, 120))) for _ in range(rng.randrange(1, 8))]
        data = np.frombuffer(b"".join(strings), np.uint8)
        order, rank = op.suffix_array(data)
        raw = data.tobytes()
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        assert rank[order].tolist() == list(range(len(raw)))
        shared = op.common_prefixes(data, order, rank, window)
        for i in range(1, len(raw)):
            a, b = raw[order[i - 1]:], raw[order[i]:]
            n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert shared[i] == min(n, window)
        seen = Counter(s[i:i + window] for s in strings for i in range(len(s) - window + 1))
        twice = op.repeated_windows(strings, window)[3]
        assert twice.tolist() == [i + window <= len(s) and seen[s[i:i + window]] > 1 for s in strings for i in range(len(s))]
        inner = np.cumsum([0, *map(len, strings)])
        order = order[order + window <= np.repeat(inner[1:], np.diff(inner))[order]]
        asked = [bytes(rng.choice(b"ab\0c") for _ in range(window)) for _ in range(20)] + [s[:window] for s in strings if len(s) >= window]
        found = op.found_in(data, order, np.frombuffer(b"".join(asked), np.uint8).reshape(-1, window), window)
        assert found.tolist() == [x in seen for x in asked]


def test_empty(empty_docs):
    assert op.deduplicated(empty_docs).count() == 0


def test_null_ids_with_one_32_bit_hash(spark, make_docs):
    """Two texts of rows without id that Spark's 32-bit hash can't tell apart; only one is in a further row."""
    text = F.concat_ws(" ", *[F.concat(F.lit(c), "id") for c in "abcdefghijkl"])
    many = spark.range(300_000).select(text.alias("text")).groupBy(F.hash("text")).agg(F.collect_list("text").alias("t"))
    a, b = many.where("size(t) > 1").first().t[:2]
    rows = [(None, a), (None, b), (0, a)]
    got = op.deduplicated(make_docs(*rows), 30, 8).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in got), key=str) == sorted(brute(rows, 30), key=str)


def test_structured_bytes_do_not_collide(make_docs):
    def order(n, a, b):
        return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))

    rows = [(i, order(n, a, b) + "." * i) for i, (n, a, b) in enumerate([(1024, "a", "b"), (1024, "b", "a"), (4096, "c", "d"), (4096, "d", "c"), (300, "e", "f")])]
    got = op.deduplicated(make_docs(*rows), window=200, gram=16).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in got) == sorted(brute(rows, 200))


def test_shard_sorts_plain_numbers(monkeypatch):
    """Indirect sorts took most of a shard's CPU time; a shard of ordinary size needs none."""
    def refused(*_, **__):
        raise AssertionError("indirect sort")

    rng = random.Random(5)
    base = bytes(rng.choice(b"abcdefgh ") for _ in range(3000))
    strings = [base[i:i + 400] for i in range(0, 2600, 130)] + [b"ab" * 300, bytes(range(256)) * 2]
    seen = Counter(s[i:i + 200] for s in strings for i in range(len(s) - 199))
    with monkeypatch.context() as m:
        m.setattr(np, "argsort", refused)
        m.setattr(np, "lexsort", refused)
        twice = op.repeated_windows(strings, 200)[3]
    assert twice.tolist() == [i + 200 <= len(s) and seen[s[i:i + 200]] > 1 for s in strings for i in range(len(s))]


def test_suffix_array_too_wide_for_one_number(monkeypatch):
    monkeypatch.setattr(op, "BITS", 0)
    rng = random.Random(6)
    for letters in (b"a", b"ab", b"ab\0c", bytes(range(256))):
        raw = bytes(rng.choice(letters) for _ in range(300)) * 2
        order, rank = op.suffix_array(np.frombuffer(raw, np.uint8))
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        assert rank[order].tolist() == list(range(len(raw)))


def test_strings_of_a_slice_in_one_batch():
    """Texts go by slices, not one by one; parts that a text doesn't hold (another text of that place does) are left out."""
    rng = random.Random(7)
    window, rows, want = 20, [], []
    for r in range(60):
        text = "".join(rng.choice("abé ") for _ in range(rng.randrange(100)))
        raw, parts = text.encode(), []
        for m in range(rng.randrange(4)):
            start, windows = rng.randrange(60), rng.randrange(1, 30)
            end = start + windows + window - 1
            s = int(range_hashes(TABLE[np.frombuffer(raw, np.uint8)], np.array([start]), np.array([end])).view(np.int64)[0]) if end <= len(raw) else 0
            wrong = rng.random() < 0.2
            parts.append({"m": m, "s": s + wrong, "start": start, "windows": windows, "copies": r, "shards": 1})
            if r >= 5 and not wrong and end <= len(raw):
                want.append((m, s, r, 1, raw[start:end]))
        rows.append({"parts": parts, "text": text})
    part = pa.struct([("m", pa.int64()), ("s", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("copies", pa.int64()), ("shards", pa.int64())])
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("parts", pa.list_(part)), ("text", pa.string())])).slice(5)
    got = list(op._strings([batch], window))
    assert len(got) == 1 and want
    assert [tuple(x.values()) for x in got[0].to_pylist()] == want
    assert [tuple(x.values()) for b in op._strings([batch], window, size=64) for x in b.to_pylist()] == want


def test_pair_of_shards_is_searched_in_blocks(monkeypatch):
    """Windows of many strings are looked up together, whatever string they stand in."""
    rng = random.Random(8)
    base = "".join(rng.choice("abc") for _ in range(90))
    strings = [(base[i:i + rng.randrange(24, 60)] + rng.choice(["", "x", "yy"])).encode() for i in range(0, 66, 3)]
    block = np.array([rng.randrange(2) for _ in strings])
    n, calls, found_in = len(strings), [], op.found_in
    monkeypatch.setattr(op, "found_in", lambda *a: calls.append(len(a[2])) or found_in(*a))
    table = pa.table({"m": np.zeros(n, np.int64), "s": np.arange(n), "copies": np.ones(n, np.int64), "packed": strings,
                      "block": block, "a": np.zeros(n, np.int64), "b": np.ones(n, np.int64)})
    sides = [{s[i:i + 20] for s, b in zip(strings, block, strict=True) if b == side for i in range(len(s) - 19)} for side in (0, 1)]
    want = {(r, i) for r, s in enumerate(strings) for i in range(len(s) - 19) if s[i:i + 20] in sides[1 - block[r]]}

    def got():
        return {(x["s"], x["low"] + i) for x in op._shard(20)(table).to_pylist() for i in range(x["size"])}

    assert got() == want and want and len(calls) == 2
    calls.clear()
    monkeypatch.setattr(op, "ASKED", 7, raising=False)
    assert got() == want and max(calls) == 7
