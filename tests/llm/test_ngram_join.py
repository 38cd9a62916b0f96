import random
import re
from collections import defaultdict

import numpy as np
import pytest

from flowspark.llm import ngram_join as op
from flowspark.llm.components import components


def brute(rows, words=5):
    """[(n, component, links)] of (id, text) rows."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append({tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    root, links = list(range(len(rows))), defaultdict(int)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least.get(find(i)) if s else rows[i][0], links[i]) for i, s in enumerate(sets)]


def texts(seed, n=120):
    """Bases, near copies at every distance, a line common to most, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = "a very common line that most of these documents hold word for word".split()
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(20, 90))] for _ in range(8)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.6:
            w += line
        out.append((i, " ".join(w).upper() if rng.random() < 0.1 else " \n".join(w)))
    return [*out, (n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "One two"), (n + 4, "one two three four five"), (n + 5, "one")]


def check(df, rows):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=str)
    assert got == sorted(((d, *x) for (d, _), x in zip(rows, brute(rows), strict=True)), key=str)


@pytest.mark.parametrize("block", [4096, 7])
def test_against_brute_force(make_docs, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "FREQUENT_FROM", 20)
    monkeypatch.setattr(op, "BROADCAST_ROWS", 10 if block == 7 else 1000)
    rows = texts(block)
    check(op.near_duplicates(make_docs(*rows)), rows)


def test_nulls_and_repeated_rows(make_docs):
    a = "one two three four five six seven eight nine ten"
    rows = [(5, a), (5, a), (None, a), (3, a + " x"), (None, "alone in the world of six"), (None, None), (9, "b")]
    docs = make_docs(*rows)
    check(op.near_duplicates(docs), rows)
    left = op.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["3", "9", "None", "None"]


def test_repeated_row_that_stays_is_kept_once(make_docs):
    a = "one two three four five six seven eight nine ten"
    left = op.drop_near_duplicates(make_docs((1, a), (1, a), (2, a + " x"), (7, None), (7, None))).collect()
    assert sorted((r.doc_id, r.text or "") for r in left) == [(1, a), (7, ""), (7, "")]


def test_empty(empty_docs):
    assert op.near_duplicates(empty_docs).count() == 0
    assert op.drop_near_duplicates(empty_docs).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}


def test_counts_are_derived_from_a_similar_set():
    rng = np.random.default_rng(0)
    base = np.sort(rng.integers(0, 2**63, 200, dtype=np.uint64))
    sets = [np.sort(np.unique(np.concatenate([base[rng.random(200) > 0.05], rng.integers(0, 2**63, 4, dtype=np.uint64)]))) for _ in range(40)]
    total, links = op.links_of(sets, np.ones(40, np.int64), lambda m: np.arange(40) != m)
    want = [sum(len(np.intersect1d(a, b)) * 100 >= 80 * len(np.union1d(a, b)) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    assert total.tolist() == want and len(links) <= 39


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") & 1] for i in range(n)]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_structured_words_and_sequences_do_not_collide(spark, make_docs, n):
    x, y = "".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))
    rows = [(i, f"one two three {w} four five") for i, w in enumerate([x, y, x])]
    rows += [(3, x), (4, y), (5, " ".join(thue_morse(n, "left", "right")) + " end"), (6, " ".join(thue_morse(n, "right", "left")) + " end")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in op.near_duplicates(make_docs(*rows)).collect()}
    assert [got[i] for i in range(7)] == brute(rows)


@pytest.mark.parametrize("twins", [op.TWINS, 0])
def test_sets_that_share_a_hash_stay_apart(spark, make_docs, monkeypatch, twins):
    monkeypatch.setattr(op, "TWINS", twins)
    honest = op.digests

    def colliding(gram, cuts):
        d1, d2 = honest(gram, cuts)
        return d1 % np.uint64(5), d2

    monkeypatch.setattr(op, "digests", colliding)
    rows = texts(4, 40)
    check(op.near_duplicates(make_docs(*rows)), rows)
