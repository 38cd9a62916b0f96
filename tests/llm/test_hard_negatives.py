import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.llm import hard_negatives as op

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10):
    """Sorted results over (id, vector, label) rows, by whole numbers of any size."""
    kept = []
    for n, (i, v, y) in enumerate(rows):
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        kept.append((n, i, [math.floor(256 * float(np.float32(x))) for x in v], y))
    out = []
    for n, i, v, y in kept:
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, z) for m, j, w, z in kept if m != n))
        for s, none, j, _, _ in [x for x in scored if x[4] == y][:positives]:
            fit = [x for x in scored if x[4] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, None if none else j, r, None if x[1] else x[2], -s, -x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, DDL).withColumn("rid", F.lit("x")).withColumn("v", F.lit(1)).withColumn("id", F.lit(2.0))
    given = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    return sorted(map(tuple, op.mine(df, label=label, **more).collect()), key=str)


def vectors(seed, n=300, dims=6):
    """Few different values, so ties abound; copies of rows and of vectors; nulls everywhere."""
    rng = random.Random(seed)
    pool = [[rng.uniform(0, 1) for _ in range(dims)] for _ in range(40)]
    rows = [(i if rng.random() < 0.95 else None, list(rng.choice(pool)) if rng.random() < 0.8 else [rng.uniform(-1, 1) for _ in range(dims)],
             rng.randrange(4)) for i in range(n)]
    rows += [(0, rows[0][1], rows[0][2]), rows[5], rows[5], (100, rows[100][1], rows[100][2]), (200, rows[3][1], 9)]
    rows += [(700, None, 1), (701, [0.1, None, 0.2], 1), (702, [float("nan")] * dims, 2), (800, [float("inf")] * dims, 2), (900, [0.5] * dims, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(op, "TILE", (2, 64))
    rows = vectors(seed)
    want = brute(rows)
    assert len(want) > 50
    assert mined(spark, rows) == want


def test_anchors_in_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", 2 * 8 * 6)
    assert mined(spark, vectors(3)) == brute(vectors(3))


def test_few_rows_unequal_lengths_and_empty_table(spark):
    rows = [(0, [0.5, 0.5], 1), (1, [0.5], 2), (3, [0.5, 0.5, 0.5], 2), (4, [], 3), (5, [0.2, 0.1], 3), (100, [0.9, 0.4], 1)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(0, [], 1)]) == [] and mined(spark, [(0, None, 1)]) == []
    assert mined(spark, [(0, [0.1], 1), (1, [0.1], 2)]) == []  # no positive


def test_products_are_exact_up_to_the_bound():
    rng = np.random.default_rng(4)
    for dims, most in ((3, 5), (64, 145), (200, 1 << 20), (130, 1 << 27), (64, (1 << 28) - 1)):
        a, b = rng.integers(-most, most + 1, (7, dims)), rng.integers(-most, most + 1, (9, dims))
        a[0], b[0], b[1] = most, most, -most
        numbers = op.Residues(dims * most * most)
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert numbers.products(numbers.of(a), numbers.of(b)).tolist() == want


def test_scores_beyond_a_long_are_an_error(spark):
    with pytest.raises(ValueError):
        mined(spark, [(0, [1e8] * 64, 1), (1, [1.0] * 64, 1)])
