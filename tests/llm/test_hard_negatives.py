"""Hard negatives against all inner products in Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonestream.llm.hard_negatives import Packed, mine

ROWS = "vec_id long, embedding array<float>, label int"
CLASHING = ROWS + ", id long, v string, anchor boolean, block int, shard int, deal long, score long"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    fine = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, (a, va, la) in enumerate(fine):
        if a % 100:
            continue
        score = [sum(x * y for x, y in zip(va, v)) for _, v, _ in fine]
        best = sorted((-score[j], fine[j][0], j) for j in range(len(fine)) if j != k and fine[j][2] == la)[:positives]
        for s, p, _ in best:
            hard = sorted((-score[j], fine[j][0]) for j in range(len(fine)) if fine[j][2] != la and -30 * s <= 100 * score[j] <= -90 * s)[:negatives]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(hard)]
    return sorted(out)


def case(n=700, dims=9, seed=1):
    r = random.Random(seed)
    rows = [(i, [r.choice([r.gauss(0, 0.4), 0.25, -0.25]) for _ in range(dims)], r.randrange(4)) for i in range(n)]
    rows += [(None, rows[0][1], 1), (2000, None, 1), (2100, rows[1][1], None), (2200, [math.nan] * dims, 1), (2300, [math.inf] * dims, 1),
             (2400, [None] * dims, 1), (2500, [0.0] * dims, 1), (2600, [], 2), (2700, [1.0, 2.0], 1), (-100, [-x for x in rows[3][1]], 3)]
    return rows + [rows[100], rows[100], rows[5], (200, rows[7][1], 2)]


def mined(spark, rows, schema=ROWS, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, mine(spark.createDataFrame(rows, schema), label, F.col("vec_id") % 100 == 0, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"shard_rows": 50, "block_anchors": 3}], ids=["one group", "many groups"])
def test_against_all_products(spark, options):
    rows = case()
    assert mined(spark, rows, **options) == plain(rows)


def test_a_third_of_all_rows_are_one(spark):
    rows = case(300)
    rows += [rows[200]] * 60 + [(17, rows[17][1], 0)] * 60
    assert mined(spark, rows, shard_rows=40) == plain(rows)


def test_empty_and_clashing(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [0.5], 1)]) == [] and mined(spark, [(100, [0.5], 1)]) == []
    rows = case(120)
    assert mined(spark, [(*r, 1, "v", True, 2, 3, 4, 5) for r in rows], CLASHING) == plain(rows)


@pytest.mark.parametrize("most", [1, 300, 1 << 20, 1 << 24])
def test_fields_never_touch(most):
    r = np.random.default_rng(most)
    x, a = r.integers(-most, most + 1, (700, 13)), r.integers(-most, most + 1, (5, 13))
    x[0], x[1], x[2], a[0] = most, -most, 0, most
    packed = Packed(x, int(np.abs(a).max()))
    assert all((packed.scores(v) == x @ v).all() for v in a)


def test_scores_beyond_a_long_are_an_error(spark):
    with pytest.raises(ValueError):
        Packed(np.full((2, 3), 1 << 30), 1 << 30)
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(100, [1e30], 1), (1, [1.0], 1)])
