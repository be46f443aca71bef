import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstream.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n=400, d=20, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, d))
    out = []
    for k in range(n):
        v = middle[rng.integers(12)] + rng.normal(size=d) * 0.3
        out.append((k, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(labels))))
    return out


def brute(rows, anchors=50):
    rows = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows
            if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, g in {(i, tuple(v), g): (i, v, g) for i, v, g in rows if i % anchors == 0}.values():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, g == f) for j, w, f in rows if j != i)
        for s, j, _ in [x for x in scored if x[2]][:5]:
            fit = [x for x in scored if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, k + 1, b, -s, -t) for k, (t, b, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    df = df.withColumns({c: F.lit("x") for c in ("v", "slot", "score", "id", "place", "block", "code", "rank")})
    return sorted(map(tuple, h.mine_negatives(df, **options).collect()))


def test_equals_brute_force(spark):
    rows = made()
    assert mined(spark, rows) == brute(rows) != []


def test_odd_rows_ties_and_lengths(spark):
    rows = made(150, d=70)
    rows += [(None, [1.0] * 70, 1), (1000, None, 1), (1050, [1.0] * 70, None), (1100, [float("nan")] * 70, 1),
             (1150, [float("inf")] + [0.0] * 69, 1), (1200, [None] * 70, 2), (1250, [], 2), (1300, [0.0] * 70, 2),
             (1350, [0.5] * 3, 1), (1400, [-3e7] * 90, 0)]
    rows += rows[:5] + [(50, rows[3][1], rows[3][2])]                     # repeated rows, a repeated id
    rows += [(2000 + k, rows[7][1], k % 3) for k in range(40)]            # equal vectors
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_blocks_of_anchors_give_the_same(spark):
    rows = made(300, d=8)
    assert mined(spark, rows, anchors=5, block_bytes=2000) == brute(rows, 5)


@pytest.mark.parametrize("d", [1, 8, 64, 100])
def test_interval_holds_the_score(d):
    rng = np.random.default_rng(d)
    turn = h.rotation(d)
    assert np.allclose(turn @ turn.T, np.eye(d))
    x, y = (rng.integers(-300, 300, (50, d)) * (rng.random((50, 1)) < 0.9) for _ in range(2))
    y[:10] = x[:10]
    rows, q = h.Codes.of(x, turn), h.Queries.of(np.arange(50), np.zeros(50), y, turn)
    low, high = h.intervals(rows, slice(0, 50), q, slice(0, 50))
    true = x @ y.T
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all()
    if d >= 8:      # and it tells pairs apart: far ones cannot reach the equal ones' scores
        assert np.median(high) < 0.85 * np.median(np.diag(true)[:10][np.diag(true)[:10] > 0])


def test_scores_beyond_64_bits_are_cut():
    big = np.full((1, 4), 1 << 40, np.int64)
    turn = h.rotation(4)
    got = h.scores(h.Codes.of(big, turn), np.array([0]), h.Queries.of(np.array([1]), np.array([0]), -big, turn), np.array([0]))
    assert got[0] == -(1 << 63)


def test_best_keeps_the_first_k():
    rng = random.Random(4)
    best, every = h.Best(3, 2), []
    for _ in range(6):
        rows = [(rng.randrange(3), rng.randrange(-4, 4), rng.randrange(9)) for _ in range(5)]
        every += rows
        best.add(*(np.array(c, np.int64) for c in zip(*rows)))
    want = [x for s in range(3) for x in sorted((r for r in every if r[0] == s), key=lambda r: (-r[1], r[2]))[:2]]
    assert list(zip(best.slot.tolist(), best.score.tolist(), best.id.tolist())) == want
