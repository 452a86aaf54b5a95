import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolake.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank int"


def direct(rows, positives=5, least=3, low=50, high=95):
    """By all pairs: {(anchor, positive): [(negative, positive's score, its score)]}."""
    whole = [(i, lab, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v, lab in rows]
    out = {}
    for a, own, v in whole:
        if a % 50 == 0:
            scored = sorted((-int(v @ w), i, lab) for i, lab, w in whole if i != a and len(w) == len(v))
            for p, i, _ in [r for r in scored if r[2] == own][:positives]:
                near = [(n, -p, -s) for s, n, lab in scored if lab != own and low * -p <= 100 * -s <= high * -p][:least]
                if near:
                    out[a, i] = near
    return out


def found(df):
    out = {}
    for r in df.orderBy("anchor_id", "positive_id", "rank").collect():
        out.setdefault((r.anchor_id, r.positive_id), []).append((r.negative_id, r.positive_score, r.negative_score))
        assert r.rank == len(out[r.anchor_id, r.positive_id])
    return out


@pytest.mark.parametrize("sizes", [{}, {"part_rows": 37, "group_rows": 2}])
def test_same_as_all_pairs(spark, sizes):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(-100, 500)]
    rows += [(i, [0.25, 1.0, 0.3], 0) for i in range(500, 700)]  # a third of all rows are copies: ties by id
    df = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA)
    assert found(negatives.mine(df, F.col("vec_id") % 50 == 0, **sizes)) == direct(rows)


def test_other_numbers(spark):
    rng = random.Random(4)
    rows = [(i, [rng.random(), rng.random()], i % 4) for i in range(200)]
    df = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA)
    got = found(negatives.mine(df, F.col("vec_id") % 50 == 0, positives=2, negatives=7, low=80, high=100))
    assert got == direct(rows, 2, 7, 80, 100)
    with pytest.raises(ValueError, match="window"):
        negatives.mine(df, F.col("vec_id") == 0, high=101)


def test_odd_rows(spark):
    good = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [0.75, 0.25], 1), (3, [], 1), (50, [], 2), (4, [], 2), (100, [0.0, 0.0], 1), (101, [0.0], 1)]
    odd = [(5, None, 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, 0.5], None), (None, [0.7, 0.3], 1), (10, [1e300, 1e300], 1), (11, [1e8, 1e8], 1)]
    df = spark.createDataFrame([(*r, None, None) for r in good + odd + good], SCHEMA)
    assert found(negatives.mine(df, F.col("vec_id") % 50 == 0)) == direct(good) | {(100, 2): [(0, 0, 0), (1, 0, 0)]} | {(50, 4): [(3, 0, 0)]}
    assert negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0], 1, None, 1), (1, [1.0], 1, None, 1), (1, [0.5], 1, None, 1), (2, [0.25], 0, None, 1)], SCHEMA)
    assert found(negatives.mine(two, F.col("vec_id") == 0)) == {(0, 1): [(2, 256 * 128, 256 * 64)]}


def test_large_scores_are_exact(spark):
    rows = [(i, [1e6 + i / 256, 3.0 + i], i % 2) for i in range(60)]
    got = found(negatives.mine(spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA), F.col("vec_id") % 50 == 0, low=50, high=100))
    assert got == direct(rows, high=100)


def test_keys_sort_as_their_parts():
    rng = np.random.default_rng(5)
    parts = [rng.integers(-(2**40), 2**40, 500) // 2**38, rng.integers(-(2**62), 2**62, 500) // 2**60, rng.integers(0, 2, 500), rng.integers(-(2**63), 2**63 - 1, 500)]
    keys = negatives.packed(*parts).to_pylist()
    rows = list(zip(*(p.tolist() for p in parts), strict=True))
    assert [negatives.unpacked(k) for k in keys] == [(a, s, bool(k), i) for a, s, k, i in rows]
    assert [r for _, r in sorted(zip(keys, rows, strict=True))] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
