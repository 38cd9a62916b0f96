import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.llm import substring_dedup as op


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = defaultdict(lambda: float("inf"))
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(least[k], float("inf") if d is None else d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (float("inf") if d is None else d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "x" * 300]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(40):
        w = [rng.choice(vocabulary[: rng.choice([1, 2, 14])]) for _ in range(rng.randrange(70))]
        if rng.random() < 0.6:
            a = rng.randrange(30)
            w += passage[a:a + rng.randrange(10, 60)]
        if rows and rng.random() < 0.3:
            w = re.split(r"\s+", rng.choice(rows)[1]) + w
        rows.append((rng.randrange(60) if rng.random() < 0.9 else None, rng.choice([" ", "\n", " \t"]).join(w)))
    return [*rows, (100, None), (101, ""), (102, "short"), rows[0], rows[0]]


@pytest.mark.parametrize(("window", "gram", "hot", "size"), [(20, 4, 20_000, 1 << 20), (12, 3, 1, 1 << 20), (20, 4, 20_000, 25)])
def test_against_brute_force(make_docs, monkeypatch, window, gram, hot, size):
    monkeypatch.setattr(op, "HOT", hot)
    rows = texts(window + hot + size)
    got = op.deduplicated(make_docs(*rows), window, gram, size=size).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows, window), key=str)
    for r in got:
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed


def test_shuffled_join(make_docs, monkeypatch):
    from flowspark.llm import supermers

    monkeypatch.setattr(supermers, "BROADCAST_ROWS", 0)
    rows = texts(5)
    got = op.deduplicated(make_docs(*rows), 15, 3).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows, 15), key=str)


def test_passage_in_many_texts_is_bounded(make_docs, monkeypatch):
    """One passage with different text around it: no task takes more than a few shards' worth of strings."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*(f"a{rng.random()}" for _ in range(25)), *passage, *(f"b{rng.random()}" for _ in range(25))])) for i in range(200)]

    def bounded(make):
        def made(window):
            run = make(window)

            def checked(strings, *more):
                if strings.num_rows > 60:
                    raise MemoryError(strings.num_rows)
                return run(strings, *more)

            return (lambda strings, smaller: checked(strings, smaller)) if make.__name__ == "_shard_ranges" else lambda strings: checked(strings)

        return made

    for name in ("_count_windows", "_shard_windows", "_shard_ranges"):
        if hasattr(op, name):
            monkeypatch.setattr(op, name, bounded(getattr(op, name)))
    monkeypatch.setattr(op, "HOT", 20)
    monkeypatch.setattr(op, "BUCKET", 20)
    got = op.deduplicated(make_docs(*rows), 25, 5).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows, 25), key=str)


def test_ranks_are_exact():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2, 500)
    for window in (1, 2, 7, 50):
        rank = op.window_ranks(words, window)
        seen = {}
        for i, r in enumerate(rank):
            assert seen.setdefault(tuple(words[i:i + window]), r) == r
        assert len(set(rank.tolist())) == len(seen)


def test_empty(empty_docs):
    assert op.deduplicated(empty_docs).count() == 0


def test_null_ids_with_one_32_bit_hash(spark, make_docs):
    """Two texts of rows without id that Spark's 32-bit hash can't tell apart; only one is in a further row."""
    text = F.concat_ws(" ", *[F.concat(F.lit(c), "id") for c in "abcdefghijkl"])
    many = spark.range(300_000).select(text.alias("text")).groupBy(F.hash("text")).agg(F.collect_list("text").alias("t"))
    a, b = many.where("size(t) > 1").first().t[:2]
    rows = [(None, a), (None, b), (0, a)]
    got = op.deduplicated(make_docs(*rows), 10, 3).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows, 10), key=str)


@pytest.mark.parametrize("n", [1024, 4096])
def test_structured_words_and_sequences_do_not_collide(make_docs, n):
    """Words and word sequences in the order of Thue and Morse collide under any polynomial hash modulo a power of two."""
    def order(a, b):
        return [(a, b)[bin(i).count("1") & 1] for i in range(n)]

    x, y = "".join(order("a", "b")), "".join(order("b", "a"))
    around = [f"w{i}" for i in range(30)]
    rows = [(0, " ".join([*around, x, *around])), (1, " ".join([*around, y, *around])), (2, " ".join([*around, x, *around])),
            (3, " ".join(order("l", "r"))), (4, " ".join(order("r", "l")))]
    got = op.deduplicated(make_docs(*rows), window=50, gram=8).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute(rows, 50))
