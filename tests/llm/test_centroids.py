import hashlib
import random

import numpy as np
import pytest

from ripplelog.llm.centroids import MOST, Tournament, cluster, digests

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, id string, vector string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def brute(rows, k, rounds, dims, scale, seed=3):
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in ok]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, _, v in sorted((name(i), list(np.float32(w)), v) for (i, v), (_, w) in zip(kept, ok))][:k]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def near(v):
        return min(range(len(centroids)), key=lambda c: (away(v, centroids[c]), c))

    for _ in range(rounds):
        won = [[] for _ in centroids]
        for _, v in kept:
            won[near(v)].append(v)
        centroids = [[sum(x) // len(w) for x in zip(*w)] if w else c for c, w in zip(centroids, won)]
    out = [(i, near(v), away(v, centroids[near(v)])) for i, v in kept]
    own = {c: sum(d for _, n, d in out if n == c) for c in range(len(centroids))}
    return [(i, c, d, own[c], sum(own.values())) for i, c, d in out], centroids


def check(spark, rows, k=4, rounds=3, dims=3, scale=8):
    got, final = cluster(table(spark, rows), k=k, rounds=rounds, dims=dims, scale=scale)
    want, centroids = brute(rows, k, rounds, dims, scale)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert final.tolist() == centroids
    return final


def test_equals_plain_rounds(spark):
    rng = random.Random(1)
    check(spark, [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(120)])
    # Points of a small grid: many ties, equal vectors, equal centroids and empty clusters.
    check(spark, [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(90)], k=7, scale=2)
    check(spark, [(i, [-0.3, 0.0, 2.0]) for i in range(40)])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 0.0]), (5, [nan, 0.0, 0.0]), (6, [-inf, 0.0, 0.0])]
    rows += [(7, [1.0, 2.0, -0.1]), (7, [1.0, 2.0, -0.1]), (7, [0.0, 0.0, 0.0]), (None, [5.0, -7.0, 0.0]), (8, [-0.0, 0.0, 1e-9])]
    check(spark, rows)
    check(spark, rows[:6])  # no usable vector
    check(spark, [])
    check(spark, rows, k=1, rounds=0)


def test_large_components_are_exact_or_an_error(spark):
    high = float(MOST // 8)
    check(spark, [(i, [high if i & b else -high for b in (1, 2, 4)]) for i in range(8)], k=3)
    with pytest.raises(Exception, match="beyond"):
        check(spark, [(1, [high * 2, 0.0, 0.0])])


def test_tournament_of_bisectors_takes_the_smaller_number_on_the_plane():
    games = Tournament(np.array([[0, 0], [2, 0], [2, 0], [0, 2]]))
    points = np.array([[1, 0], [2, 0], [1, 1], [0, 1], [-5, 9]])
    assert games.winners(points).tolist() == [0, 1, 0, 0, 3]
    assert games.normals[0, 1].tolist() == [4, 0] and games.thresholds[0, 1] == 4


def test_digest_of_components():
    assert digests(np.array([[1, -2]])) == [hashlib.sha256(b"1,-2").hexdigest()]
