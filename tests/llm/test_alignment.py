import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.llm import alignment as op

files = pytest.importorskip("public_tokenizers")
A, B = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    return op.Aligner(A, B)


def brute(rows, tools):
    """Contract columns of (id, text) rows by the libraries and sets of ends."""
    letters, whole, model = op.byte_letters(), tools.a.whole, tools.b.model
    vocab = {i: t for t, i in whole.get_vocab().items()}
    out, links, count = [], [], Counter()
    for d, t in rows:
        t = t or ""
        a = whole.encode(" " + t, add_special_tokens=False).ids if t else []
        b = model.encode(t)
        raw_a = [bytes(letters[c] for c in vocab[i]) for i in a]
        raw_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        text = (" " + t).encode()
        if not t or b"".join(raw_a) != text or b"".join(raw_b) != text:
            out.append([d, 0, 0, 0, 0, ""])
            links.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, own, i, j = [], [], 0, 0
        for c in sorted(set(ends_a) & set(ends_b)):
            i0, j0 = i, j
            i, j = ends_a.index(c) + 1, ends_b.index(c) + 1
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            own += [(a[u], b[v]) for u in range(i0, i) for v in range(j0, j)
                    if max(ends_a[u] - len(raw_a[u]), ends_b[v] - len(raw_b[v])) < min(ends_a[u], ends_b[v])]
        count.update(own)
        links.append(own)
        out.append([d, len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(*o[:5], sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), o[5]) for o, own in zip(out, links, strict=True)]


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "The", "tokenization", "x", "Zürich", "naïve", "don't", "42", "3.14", "...", "日本語", "😀", "ﬁ", "<s>", "</s>", "<|endoftext|>",
             "\n", "\t", "  ", "\xa0", "\x85", "\x00", "œuvre", "supercalifragilistic", "ab\x1ccd", "é", "“quoted”"]
    return ["".join(rng.choice(words) + rng.choice([" ", "", "  ", "\n"]) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def digests(df):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in op.alignment_digests(df, A, B).select(cols).collect()), key=str)


@pytest.mark.parametrize("frequent", [op.FREQUENT, 20, 0])
def test_equals_brute_force(spark, make_docs, tools, monkeypatch, frequent):
    monkeypatch.setattr(op, "FREQUENT", frequent)
    rows = list(enumerate(texts(1))) + [(900, None), (901, ""), (902, " "), (903, "x▁y"), (None, "no id"), (904, "same text"), (904, "same text"), (None, None)]
    docs = make_docs(*rows).withColumn("rid", F.lit("x")).withColumn("a", F.lit(1)).withColumn("rest", F.lit(1))
    want = brute(rows, tools)
    assert digests(docs) == sorted(want, key=str)
    assert want[63][1:] == (0, 0, 0, 0, 0, 0, "")  # B reads the bar as a blank


def test_long_texts_in_parts_equal_whole_ones(spark, make_docs, tools, monkeypatch):
    monkeypatch.setattr(op, "SLICE", 300)
    rows = [(0, "The quick brown fox, jumps over 42 lazy dogs. " * 60), (1, "z" * 5000), (2, "ab cd " * 300 + "▁" + " ef" * 300),
            (3, "word  two   blanks\n\n" * 80), (4, "".join(texts(7, 30))), (5, "short")]
    want = brute(rows, tools)
    monkeypatch.setattr(op.batches, "__defaults__", (300,))
    monkeypatch.setattr(op.parts, "__defaults__", (300,))
    df = make_docs(*rows)
    assert digests(df) == sorted(want, key=str)
    groups = op.align(df, A, B).orderBy("doc_id", "group_no").collect()
    for d, t in rows:
        own = [g for g in groups if g.doc_id == d]
        told = ";".join(",".join(map(str, g.a_ids)) + "|" + ",".join(map(str, g.b_ids)) for g in own)
        assert (hashlib.sha256(told.encode()).hexdigest() if own else "") == want[d][7]
        assert [g.group_no for g in own] == list(range(len(own)))
        if own:
            assert own[0].start == 0 and own[-1].end == len(t.encode()) + 1
            assert all(x.end == y.start for x, y in zip(own, own[1:]))


def test_fast_ids_equal_the_library(tools):
    assert tools.a.fast is not None
    rng = random.Random(3)
    for t in [chr(c) for c in range(1, 0x240)] + texts(5, 300):
        for s in (t, f"a{t}b", f" {t} {t}x", "".join(rng.choices(t + "a '1", k=9))):
            if not any(c >= 0xC9 for c in s.encode()):
                assert tools.a.ids(s, True).tolist() == tools.a.whole.encode(s, add_special_tokens=False).ids, repr(s)


@pytest.mark.parametrize("work", [1, 3, 64])
def test_merge_path_finds_every_overlap(work):
    rng = random.Random(work)
    for _ in range(200):
        n = rng.randrange(1, 60)
        a, b = (sorted(rng.sample(range(1, n), rng.randrange(n))) + [n] for _ in range(2))
        i, j, group = op.merge_path(np.array(a), np.array(b), work)
        common = sorted(set(a) & set(b))
        want = [(x, y, sum(c < max(a[x], b[y]) for c in common)) for x in range(len(a)) for y in range(len(b))
                if max([0, *a][x], [0, *b][y]) < min(a[x], b[y])]
        assert sorted(zip(i.tolist(), j.tolist(), group.tolist())) == sorted(want)
        assert len(want) == len(a) + len(b) - len(common)


def test_empty_table(spark, empty_docs):
    assert digests(empty_docs) == [] and op.align(empty_docs, A, B).count() == 0
