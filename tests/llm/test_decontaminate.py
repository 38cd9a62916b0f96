import random

import numpy as np
import pytest

from flowspark.llm import decontaminate as op

SYLLABLES = ["an", "the", "tion", "er", "ou", "wh", " ", " of "]


def said(rng, n):
    return op.normalized("".join(rng.choice(SYLLABLES) for _ in range(n)))


def distance(item, text):
    """Least edits between item and any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_no_match_is_lost_or_made_up():
    rng = random.Random(1)
    for _ in range(12):
        items = [(i, said(rng, rng.randrange(5, 60))) for i in range(5)]
        index, docs = op.Index(items), [""]
        for _ in range(8):
            x = list(rng.choice(items)[1])
            for _ in range(rng.randrange(8)):
                p, kind = rng.randrange(len(x)), rng.random()
                if kind < 0.33:
                    x[p] = "z"
                elif kind < 0.66 and len(x) > 1:
                    del x[p]
                else:
                    x.insert(p, "q")
            docs.append(op.normalized(said(rng, rng.randrange(30)) + " " + "".join(x) + said(rng, rng.randrange(30))))
        found = index.matches(op.codes("".join(docs)), np.cumsum([0, *map(len, docs)]))
        for d, doc in enumerate(docs):
            for i, t in items:
                k = op.edit_budget(len(t))
                edits = distance(t, doc) if k >= 0 else 99
                got = [m for m in found.get(d, []) if m[0] == i]
                assert bool(got) == (k >= 0 and edits <= k)
                for m in got:
                    assert distance(t, doc[m[1]:m[2]]) == m[3]
                assert not got or min(m[3] for m in got) == edits


@pytest.fixture
def benchmark(spark):
    rng = random.Random(2)
    rows = [(i, said(rng, 50)) for i in range(6)] + [(None, said(rng, 50)), (98, None), (99, ""), (100, "short")]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def test_documents(make_docs, benchmark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_CHARS", 200)  # several blocks
    frame, items = benchmark
    rng = random.Random(3)
    clean = said(rng, 200)
    leaky = clean + " " + items[2][1].upper().replace(" ", "\n ") + " " + clean
    docs = make_docs(clean, leaky, None, "", "short", (None, items[6][1]), (1, leaky), "x " * 100_000 + items[4][1])
    got = op.with_matches(docs, frame, out="found").collect()
    assert [[m.item_id for m in r.found] for r in got] == [[], [2], [], [], [], [None], [2], [4]]
    left = op.drop_contaminated(docs, frame)
    assert left.columns == docs.columns
    assert [r.doc_id for r in left.collect()] == [0, 2, 3, 4]


def test_empty(spark, empty_docs, make_docs, benchmark):
    assert op.drop_contaminated(empty_docs, benchmark[0]).count() == 0
    assert op.drop_contaminated(make_docs("a"), benchmark[0].limit(0)).count() == 1


def test_long_items_and_long_bands_keep_their_edits():
    """Items of some thousand characters with scattered edits: found with just the edits that were made, or fewer."""
    rng = random.Random(9)
    item = "".join(rng.choice("abcdefghij ") for _ in range(3000)).strip()
    item = op.normalized(item)
    index = op.Index([(1, item)])
    k = int(index.k[0])
    for edits in (0, 7, k):
        x = list(item)
        for p in rng.sample(range(len(x)), edits):
            x[p] = "z"
        doc = op.normalized("x " * 50 + "".join(x) + " y" * 50)
        (got,) = index.matches(op.codes(doc), np.array([0, len(doc)]))[0]
        assert got[0] == 1 and got[3] == edits
        assert got[1] == doc.index("".join(x)) and got[2] == got[1] + len(x)
    x = ["z" if i % 8 == 0 else c for i, c in enumerate(item)]
    doc = "".join(x)
    assert not index.matches(op.codes(doc), np.array([0, len(doc)]))


def test_items_with_one_stem_share_their_rows(monkeypatch):
    """Thousands of items with one stem against a text that repeats it: rows of the stem are worked out once for a place."""
    rng = random.Random(10)
    stem = "which of the following statements about the river is true? "
    items = [(i, op.normalized(stem + said(rng, 18))) for i in range(3000)]
    index = op.Index(items)
    text = op.normalized(stem * 20 + items[7][1] + " " + stem * 3)
    rows, keep = [0], op.Band.align

    def counted(self, item):
        before = min(len(self.rows), 1 + int(np.argmin(np.append(item[:len(self.item)] == self.item[:len(item)], False))))
        found = keep(self, item)
        rows[0] += max(0, len(self.rows) - before)
        return found

    monkeypatch.setattr(op.Band, "align", counted)
    monkeypatch.setattr(op, "HITS", 5000)  # many blocks: what is held stays small
    got = index.matches(op.codes(text), np.array([0, len(text)]))[0]
    assert [m[0] for m in got if m[3] == 0] == [7]
    whole = sum(len(t) for _, t in items)
    assert rows[0] < 40 * whole


def test_blocks_of_hits_change_nothing(monkeypatch):
    rng = random.Random(11)
    items = [(i, said(rng, 40)) for i in range(30)]
    docs = [op.normalized(said(rng, 30) + " " + rng.choice(items)[1] + " " + said(rng, 30)) for _ in range(12)]
    points, ends = op.codes("".join(docs)), np.cumsum([0, *map(len, docs)])
    want = op.Index(items).matches(points, ends)
    monkeypatch.setattr(op, "HITS", 7)
    assert op.Index(items).matches(points, ends) == want and len(want) == 12
