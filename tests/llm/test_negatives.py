import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripplelog.llm import negatives
from ripplelog.llm.negatives import MOST, Block, among_best, hard_negatives, in_windows, scan

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, score string, nth string, rank string"
ORDER = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA).repartition(3)


def brute(rows, every, dims, scale, k=5, n=3):
    kept = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, last = [], lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (i, label, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, m) for b, (j, m, w) in enumerate(kept) if b != a]
        for p, j, _ in sorted((s for s in scored if s[2] == label), key=last)[:k]:
            fits = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(i, j, rank, s[1], p, s[0]) for rank, s in enumerate(sorted(fits, key=last)[:n], 1)]
    return out


def check(spark, rows, every=5, dims=6, scale=16):
    got = hard_negatives(table(spark, rows), every=every, dims=dims, scale=scale)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert got.columns == ORDER
    want = brute(rows, every, dims, scale)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    return want


def test_equals_all_scores(spark, monkeypatch):
    rng = random.Random(2)
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(i, [c + rng.gauss(0, 0.7) for c in centre[i % 3]], i % 3) for i in range(150)]
    assert check(spark, rows)
    # Few values: many equal scores, and ties at every bound.
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(6)], rng.randrange(4)) for i in range(150)]
    assert check(spark, rows, scale=1)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "HELD", 32)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    assert check(spark, rows, scale=1)


def test_one_hot_label_and_equal_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.5, 0.0, 0.0, 0.0], 1) for i in range(60)]
    rows += [(i, [0.8, 0.1, 0.4, float(i % 2), 0.0, 0.0], 2 + i % 2) for i in range(60, 80)]
    assert check(spark, rows)


def test_odd_rows(spark):
    v, nan = [1.0, 0.5, 0.0, -0.5, 0.2, 0.0], float("nan")
    rows = [(0, v, 1), (0, v, 1), (5, v, 1), (None, v, 1), (1, [x * 0.8 for x in v], 2), (None, [x * 0.8 for x in v], 2)]
    rows += [(1, [x * 0.8 for x in v], 2), (10, None, 1), (15, [], 1), (20, v[:5], 1), (25, [nan, *v[1:]], 1)]
    rows += [(30, [None, *v[1:]], 1), (35, v, None), (40, [float("inf"), *v[1:]], 2), (45, [0.0] * 6, 3), (50, [0.0] * 6, 3)]
    assert check(spark, rows)
    assert check(spark, [(1, v, 1), (2, v, 2)]) == []  # no anchor
    assert check(spark, [(0, v, 1)]) == []
    assert check(spark, []) == []


def test_large_components_are_exact_or_an_error(spark):
    high = float(MOST)
    rows = [(i, [high, -high, high, 0.0, high, high * (i % 3) / 4], i % 2) for i in range(20)]
    assert check(spark, rows, scale=1)
    with pytest.raises(Exception, match="beyond"):
        check(spark, [(1, [high * 2] * 6, 1)], scale=1)


def test_label_expression(spark):
    rows = [(i, [1.0 - i / 40, 0.1 * (i % 3), 0.0, 0.0, 0.0, 0.0], 0) for i in range(12)]
    got = hard_negatives(table(spark, rows), every=5, dims=6, scale=16, label=F.col("vec_id") % 2)
    want = brute([(i, v, i % 2) for i, v, _ in rows], 5, 6, 16)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_scan_drops_candidates_before_the_last_dimension():
    rng = np.random.default_rng(3)
    columns = rng.integers(-20, 20, (64, 500)).astype(float)
    columns[:4] *= np.where(rng.random(500) < 0.02, 50, 1)
    block = Block(0, np.arange(500), np.zeros(500, bool), np.zeros(500, int), columns, columns.min(axis=1).astype(int), columns.max(axis=1).astype(int))
    anchor = np.where(np.arange(64) < 4, 900, 1)
    seen = []

    def watched(keep):
        def look(sums, least, most):
            seen.append(len(sums))
            return keep(sums, least, most)
        return look

    rows, scores = scan(anchor, block, np.ones(500, bool), watched(among_best(5, None)))
    exact = (anchor @ columns).astype(int)
    assert set(np.argsort(-exact)[:5]) <= set(rows.tolist()) and (scores == exact[rows]).all()
    assert seen[0] == 500 and seen[1] < 100
    low, high = int(np.sort(exact)[-60]), int(np.sort(exact)[-20])
    rows, _ = scan(anchor, block, np.ones(500, bool), in_windows(3, [(low, high, None)]))
    inside = np.flatnonzero((exact >= low) & (exact <= high))
    assert set(inside[np.argsort(-exact[inside])][:3]) <= set(rows.tolist()) and len(rows) < 200
