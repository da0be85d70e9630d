from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from ripplelog.llm import mixing as M


def targets(sizes, weights, epochs=3):
    """Share, clamp what is above its cap, share again."""
    left, free, out = sum(sizes), set(range(len(sizes))), {}
    while free:
        level = Fraction(left, sum(weights[i] for i in free))
        over = [i for i in free if level * weights[i] >= epochs * sizes[i]]
        if not over:
            return {**out, **{i: level * weights[i] for i in free}}
        for i in over:
            out[i] = Fraction(epochs * sizes[i])
            left -= epochs * sizes[i]
            free.remove(i)
    return out


def test_water_filling_reaches_the_fixed_point(spark):
    cases = [[1, 100, 100], [5], [0, 7], [1, 1, 1000, 3], [10, 0, 0, 400, 2, 9], [0, 0]]
    for sizes in cases:
        weights = [i % 3 + 1 for i in range(len(sizes))]
        rows = spark.createDataFrame(
            [(i, n, w) for i, (n, w) in enumerate(zip(sizes, weights))], "place long, source_size long, weight long"
        ).withColumn("name", F.col("place"))
        got = {r.name: r.target for r in M.water_fill(rows).collect()}
        for i, want in targets(sizes, weights).items():
            assert abs(got[i] - float(want)) < 1e-6, (sizes, got)


def test_taken_words_meet_targets_and_caps(spark):
    rows = [(i, "w " * (i % 37), "abcd"[min(i % 9, 3)]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = M.mix(df).collect()
    assert len(got) == 900
    source = {i: s for i, _, s in rows}
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.id]] += r.taken
        target[source[r.id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(map(tuple, M.mix(df.repartition(2)).collect())) == sorted(map(tuple, got))


def test_repeated_documents_have_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 11)), "ab"[i % 7 == 0]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r.id: r.taken for r in M.mix(df).collect()}
    words = Counter()
    text = {i: t for i, t, _ in rows}
    for r in M.repeat_documents(df).collect():
        assert text[r.doc_id].startswith(r.text) and r.text
        words[r.doc_id] += len(r.text.split())
    assert {i: n for i, n in taken.items() if n} == dict(words)


def test_odd_rows(odd):
    got = M.mix(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 3 * r.size for r in got)
    assert M.repeat_documents(odd).columns == odd.columns
    assert M.repeat_documents(odd).count() > 0
    assert M.mix(odd.limit(0)).collect() == [] and M.repeat_documents(odd.limit(0)).collect() == []
