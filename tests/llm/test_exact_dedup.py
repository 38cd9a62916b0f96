import hashlib
import re

from flowspark.llm import exact_dedup as op


def plain(rows):
    """Brute force: {index: (keep, size)} by normalised text."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    return norm


def test_equal_after_white_space(make_docs):
    long = "word " * 30_000 + "end."
    rows = [(7, "a  b"), (3, "a\tb"), (5, "a b "), (9, None), (8, ""), (4, long), (2, long.replace(" ", "\n")), (None, "a b"), (6, "A b")]
    got = {(r.doc_id, r.text_sha256): r for r in op.exact_duplicates(make_docs(*rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        same = [j for j, u in rows if re.sub(r"[\x20\x09-\x0D]+", " ", u or "") == n]
        keep = min(j for j in same if j is not None)
        r = got[i, hashlib.sha256(n.encode()).hexdigest()]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(same), i == keep)


def test_repeated_rows_keep_one(make_docs):
    got = op.exact_duplicates(make_docs((1, "x y"), (1, "x y"), (None, "z"), (None, "z"))).collect()
    assert sorted((str(r.doc_id), r.group_size, r.kept) for r in got) == [("1", 2, False), ("1", 2, True), ("None", 2, False), ("None", 2, True)]


def test_empty(empty_docs):
    assert op.exact_duplicates(empty_docs).count() == 0
    assert op.drop_exact_duplicates(empty_docs).count() == 0


def test_drop_keeps_columns(make_docs):
    docs = make_docs((2, "a b"), (1, "a\nb"), (1, "a b"), (3, "c"), (None, None), (None, ""))
    left = op.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id)) for r in left.collect()) == ["1", "3", "None"]


def test_shared_identifiers_are_told_apart(make_docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(op, "chunk_id", lambda c: F.encode(F.substr(c, F.lit(1), F.lit(1)), "utf-8"))  # collides on purpose
    got = {r.doc_id: r.group_size for r in op.exact_duplicates(make_docs("ab", "ac", "ab", "b")).collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 1}
    monkeypatch.setattr(op, "LISTED", 0)
    got = {r.doc_id: r.group_size for r in op.exact_duplicates(make_docs("ab", "ac", "ab", "b")).collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 1}


def test_native(make_docs):
    plan = op.exact_duplicates(make_docs("a"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
