import random
import zlib

import numpy as np
import pytest

from flowspark.llm import packing as op
from flowspark.llm.wordtok import WordTokenizer

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(op.default_tokenizer())


def test_ids_equal_the_library(words):
    rng = random.Random(5)
    alphabet = "ab'sstredvmlAZ09!?<|>é ÀÉßäÿ×÷²́中İ\x1c\x85\xa0 \n\t.,-"
    texts = ["".join(rng.choices(alphabet[:rng.choice([20, 30, 40, len(alphabet)])], k=rng.randrange(40))) for _ in range(800)]
    texts += ["x <|endoftext|> y", "it's we'll THEY'RE d'or 'sa !'s", "", " \n"]
    raw = [t.encode() for t in texts]
    ids, cuts = words.batch(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(texts):
        want = words.whole.encode(t, add_special_tokens=False).ids
        assert list(ids[cuts[i]:cuts[i + 1]]) == want
        assert list(words.ids(np.frombuffer(raw[i], np.uint8))) == want


def test_long_text_is_cut_at_white_space(words, monkeypatch):
    from flowspark.llm import wordtok

    monkeypatch.setattr(wordtok, "SLICE", 64)
    monkeypatch.setattr(wordtok, "REMEMBERED", 10)
    text = "The worlds' end isn't near, says " * 50 + "x" * 200 + " end"
    assert list(words.ids(np.frombuffer(text.encode(), np.uint8))) == words.whole.encode(text, add_special_tokens=False).ids


def test_histogram_is_packed_whole():
    for seed in range(60):
        rng = random.Random(seed)
        size = rng.choice([16, 64, 4096])
        counts = {n: rng.randrange(1, rng.choice([3, 50, 5000])) for n in rng.sample(range(1, size + 1), rng.randrange(1, min(size, 200)))}
        got: dict[int, int] = {}
        patterns = op.pack_histogram(counts, size)
        for number, held in patterns:
            assert number > 0 and sum(n * k for n, k in held) <= size
            for n, k in held:
                got[n] = got.get(n, 0) + number * k
        assert got == counts and len(patterns) <= 2 * size + 2


def test_pieces_and_places(make_docs, words):
    texts = ["a b c", "", None, "word " * 9000, "x", "x", "tail " * 300]
    docs = make_docs(*texts, (None, "null id"), (4, "x"))
    got = op.pack_documents(docs, op.default_tokenizer()).collect()
    ids = {}
    for i, t in [*enumerate(texts), (None, "null id")]:
        ids[i] = np.array([*words.whole.encode(t or "", add_special_tokens=False).ids, op.END_ID], "<u4")
    assert sum(r.length for r in got) == sum(map(len, ids.values())) + len(ids[4])
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= op.SIZE


def test_little_padding(spark, make_docs):
    rng = random.Random(1)
    docs = make_docs(*["w " * rng.randrange(1, 3000) for _ in range(400)])
    got = op.pack_documents(docs, op.default_tokenizer()).collect()
    sequences = len({r.sequence_id for r in got})
    assert sum(r.length for r in got) / (op.SIZE * sequences) > 0.97


def test_empty(empty_docs):
    assert op.pack_documents(empty_docs, op.default_tokenizer()).count() == 0


def test_words_that_share_a_hash_keep_their_own_ids(words, monkeypatch):
    """Words of two letters in the order of Thue and Morse collide under any odd base modulo a power of two."""
    for n in (1024, 2048, 4096):
        x = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        y = x.translate(str.maketrans("ab", "ba"))
        for texts in ([f"in {x} out", f"in {y} out", y], [f"{x} {y} {x}", y]):
            raw = [t.encode() for t in texts]
            ids, cuts = words.batch(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
            for i, t in enumerate(texts):
                assert list(ids[cuts[i]:cuts[i + 1]]) == words.whole.encode(t, add_special_tokens=False).ids
