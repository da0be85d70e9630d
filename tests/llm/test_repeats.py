import random

from ripplelog.llm import repeats as R


def brute(texts, size):
    where = {}
    split = [(t or "").lower().split() for t in texts]
    for d, w in enumerate(split):
        for i in range(len(w) - size + 1):
            where.setdefault(tuple(w[i : i + size]), set()).add(d)
    out = set()
    for d, w in enumerate(split):
        stretch = None
        for i in range(len(w) - size + 1):
            docs = where[tuple(w[i : i + size])]
            if len(docs) > 1:
                other = max(docs) if d == min(docs) else min(docs)
                if stretch and i <= stretch[1]:
                    stretch = (stretch[0], i + size, min(stretch[2], other))
                else:
                    if stretch:
                        out.add((d, *stretch))
                    stretch = (i, i + size, other)
        if stretch:
            out.add((d, *stretch))
    return out


def test_equals_brute_force(docs, prose):
    rng = random.Random(9)
    shared = [prose(50 + i, n) for i, n in enumerate((49, 50, 51, 75, 200))]
    texts = []
    for i in range(80):
        parts = [prose(1000 * i + j, rng.randrange(60)) for j in range(3)]
        for _ in range(rng.randrange(3)):
            words = rng.choice(shared).split()
            a = rng.randrange(max(1, len(words) - 60))
            parts.insert(rng.randrange(4), " ".join(words[a : a + rng.randint(45, 80)]))
        texts.append("\n ".join(parts).upper() if i % 5 == 0 else " ".join(parts))
    texts += [shared[4]] * 3 + ["z " * 400, "z " * 300, prose(7, 60) + " " + prose(7, 60), None, ""]
    got = {tuple(r) for r in R.repeated_passages(docs(texts)).collect()}
    assert got == brute(texts, 50) and len(got) > 30


def test_other_sizes(docs, prose):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(12)]
    got = {tuple(r) for r in R.repeated_passages(docs(texts), passage=9, prefix=3).collect()}
    assert got == brute(texts, 9) and got


def test_sides_that_agree_with_different_documents(spark, docs, prose):
    a, b, m = prose(1, 40), prose(2, 40), prose(3, 20)
    sides = [f"{a} {m} {b}", f"{a} {m} {prose(4, 45)}", f"{prose(5, 45)} {m} {b}"]
    # Words that many documents have, each with words of its own around them, and copies.
    common = [f"{prose(100 + i, 12)} {m} {prose(300 + i, 50)}" for i in range(60)]
    texts = sides + common + [common[0]] * 40
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # several ranges, also of so few rows
    try:
        got = {tuple(r) for r in R.repeated_passages(docs(texts)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == brute(texts, 50) and {r[0] for r in got} == {0, 1, 2, 3, *range(63, 103)}


def test_odd_rows(spark, odd):
    assert R.repeated_passages(odd).collect() == []
    again = odd.union(odd.withColumn("doc_id", odd["doc_id"] + 100))
    assert {(r.id, r.other) for r in R.repeated_passages(again).collect()} == {(5, 105), (105, 5)}
    assert R.repeated_passages(odd.limit(0)).collect() == []
