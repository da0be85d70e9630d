import hashlib
import re
from statistics import mean, pstdev

from pyspark.sql import functions as F

from ripplelog.llm import fingerprints as P


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_estimates_are_unbiased_and_edits_exact(docs, prose):
    texts = [prose(i, [1, 3, 4, 5, 6, 12, 40, 150, 400][i % 9]) for i in range(270)]
    got = {r.id: r for r in P.compare_edits(docs(texts)).collect()}
    errors = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(text), edited)
        errors.append(r.near_edited - likeness(shingle_set(text), shingle_set(edited)))
        assert r.near_next < 0.15
    assert abs(mean(errors)) < 0.01 and pstdev(errors) < 0.04


def test_densified_bins_equal_a_slow_filling(spark, prose):
    """Each empty bin takes the first full bin of its probing order."""
    text = prose(5, 30)
    row = spark.createDataFrame([(text,)], "t string").select(
        P._bins(P.shingle_hashes(F.col("t"))).alias("bins"), P._densified(P._bins(P.shingle_hashes(F.col("t")))).alias("full")
    ).first()
    n = P.BINS
    probes = spark.range(n).select(
        "id", *[F.pmod(F.xxhash64(F.col("id").cast("int"), F.lit(a)), F.lit(n)).alias(f"p{a}") for a in range(P.PROBES)]
    ).collect()
    order = {
        r.i: [x.j for x in sorted(r.js)]
        for r in spark.range(n).select(F.col("id").cast("int").alias("i")).crossJoin(
            spark.range(n).select(F.col("id").cast("int").alias("j"))
        ).groupBy("i").agg(F.collect_list(F.struct(F.xxhash64("j", "i").alias("h"), "j")).alias("js")).collect()
    }
    assert sum(x is not None for x in row.bins) <= 26
    for r in probes:
        if row.bins[r.id] is not None:
            want = row.bins[r.id]
        else:
            want = next(row.bins[j] for j in [*[r[f"p{a}"] for a in range(P.PROBES)], *order[r.id]] if row.bins[j] is not None)
        assert row.full[r.id] == want


def test_next_rows_over_sparse_ids(spark):
    ids = [None, -(2**62), -5, 0, 1, 2, 500, 10**15, 2**62]
    df = spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string").repartition(4)
    got = {r.v: r.next.v for r in P.with_next(df, "id", ["v"], per_bucket=2).collect()}
    assert got == {f"v{a}": f"v{b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_odd_rows(odd):
    got = P.compare_edits(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) in (0, P.BINS)
    same = {r.fingerprint for r in got if r.n_chars == 7}
    assert len(same) == 1
    assert P.compare_edits(odd.limit(0)).collect() == []
    one = P.compare_edits(odd.where("doc_id = 6")).first()
    assert hashlib.sha256(one.edited.encode()) and one.near_next == 1.0  # its own next
