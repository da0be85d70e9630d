import random
import re

from ripplelog.llm import pii as P

# The shapes of the contract.
SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in SHAPES.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def test_base_spans_equal_plain_regexes(docs):
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "x@y.z", "+", "-", " ", "(", ")", "1", "25", "256", "0", "00", ".", "4111 1111-1111 1111", "\n", "é", "\U0001f600", "%", "_", "4539578763621486", "1.2.3.4", "+49 30 1234567"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(700)]
    texts += ["a." * 3000 + "@x" + ".y" * 3000, "1." * 4000, "+1 " * 3000, "9 " * 5000, "a" * 50_000 + "@", "x@y.z " * 1500]
    got = {r.id: [tuple(x) for x in r.base] for r in P.find_identifiers(docs(texts)).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text[:200]


def test_contexts_reveal_identifiers(docs):
    texts = [f"please write mail to u{i}x@site{i}.org today" for i in range(12)]
    texts += ["then write mail to agent-007-zz now", "and 42 apples", "é write mail to (q8r9) é"]
    texts += [f"room number {i}" for i in range(300, 320)]
    got = {r.id: r.learnt for r in P.find_identifiers(docs(texts)).collect()}
    text = texts[12]
    assert [(x.kind, text[x.start : x.end]) for x in got[12]] == [("context", "agent-007-zz")]
    assert [texts[14][x.start : x.end] for x in got[14]] == ["q8r9"]
    assert all(not got[i] for i in got if i not in (12, 14))


def test_scores_spread_in_rounds(spark):
    """A context gets its weight from instances that another context has made likely."""
    edges = [("a", f"s{i}", "email") for i in range(6)] + [("a", f"n{i}", None) for i in range(1)]
    edges += [("b", f"s{i}", "email") for i in range(5)] + [("b", "n0", None)]
    edges += [("c", "n0", None), ("c", "m", None)]
    df = spark.createDataFrame(edges, "context string, instance string, kind string")
    assert {tuple(r) for r in P.learn_contexts(df).collect()} == {("a", "email"), ("b", "email")}
    assert P.learn_contexts(df, precision=0.9).collect() == []


def test_identifiers_with_spaces_and_without_digits_are_whole(docs):
    """A spaced phone is one instance, its context the words before all of it."""
    texts = [f"so ring desk at +1 ({200 + i}) 555-{1000 + i} again" for i in range(12)]
    texts += ["so ring desk at 555 0199 x7 again", "so ring desk at <Reception>, again", "so ring desk of reception 77 x"]
    got = {r.id: r.learnt for r in P.find_identifiers(docs(texts)).collect()}
    assert {i: [texts[i][x.start : x.end] for x in got[i]] for i in got if got[i]} == {12: ["555 0199 x7"], 13: ["Reception"]}


def test_words_after_a_context_count_against_it(docs):
    texts = [f"so ring desk at +1 ({200 + i}) 555-{1000 + i} again" for i in range(8)]
    texts += [f"so ring desk at {w} again" for w in ("noon", "night", "dawn", "dusk", "will")] + ["so ring desk at 555 0199"]
    assert not any(r.learnt for r in P.find_identifiers(docs(texts)).collect())


def test_rounds_end_when_the_contexts_stay(spark):
    """A chain of contexts, each trusted by what the one before reveals, longer than three rounds."""
    edges = [("c0", f"s{i}", "email") for i in range(40)] + [("c0", "n0-0", None)]
    for step in range(6):
        edges += [(f"c{step + 1}", f"s{i}", "email") for i in range(4)]
        edges += [(f"c{step + 1}", f"n{step}-0", None), (f"c{step + 1}", f"s{step}x", "email"), (f"c{step + 1}", f"n{step + 1}-0", None)]
    df = spark.createDataFrame(edges, "context string, instance string, kind string")
    assert {r.context for r in P.learn_contexts(df).collect()} == {f"c{i}" for i in range(7)}


def test_odd_rows(odd):
    got = P.find_identifiers(odd).collect()
    assert len(got) == odd.count()
    assert [[x.kind for x in r.base] for r in got if r.id == 6] == [["email"]]
    assert P.find_identifiers(odd.limit(0)).collect() == []


def test_a_context_of_many_strings_is_no_context(docs, monkeypatch):
    """Seeds must be one in RARITY of what follows, counted over the whole corpus."""
    texts = [f"so ring desk at +1 ({200 + i}) 555-{1000 + i} again" for i in range(8)]
    texts += ["so ring desk at noon"] * 60 + ["so ring desk at 555 0199 x7"]
    got = {r.id: r.learnt for r in P.find_identifiers(docs(texts)).collect()}
    assert {i for i in got if got[i]} == set(range(8, 69))  # noon follows it but is one word
    monkeypatch.setattr(P, "RARITY", 5)
    assert not any(r.learnt for r in P.find_identifiers(docs(texts)).collect())


def test_a_context_counts_by_distinct_strings_however_often_they_occur(docs):
    texts = [f"so ring desk at +1 ({200 + i}) 555-{1000 + i} again" for i in range(8)] + ["so ring desk at noon"] * 300
    got = {r.id: [(x.start, x.end) for x in r.learnt] for r in P.find_identifiers(docs(texts)).collect()}
    assert [got[i] for i in range(308)] == bootstrap(texts)
    assert {i for i in got if got[i]} == set(range(8, 308))


def test_learnt_spans_equal_a_plain_bootstrap(docs):
    rng = random.Random(9)
    heads = ["mail to", "ring desk", "call me", "see at", "of the"]
    texts = []
    for i in range(260):
        parts = []
        for _ in range(rng.randint(1, 4)):
            head = rng.choice(heads)
            tail = {
                "mail to": f"u{rng.randrange(80)}@h.org", "ring desk": f"+49 30 {rng.randrange(10**6, 10**7)}",
                "call me": rng.choice(["ada", "bob", f"+49 30 {rng.randrange(10**6, 10**7)}"]),
                "see at": rng.choice(["noon", "x7", f"u{rng.randrange(80)}@h.org", "dusk", "room", "q9"]), "of the": f"w{rng.choice('abcdefghijkl')}",
            }[head]
            if head in ("mail to", "ring desk") and rng.random() < 0.05:
                tail = rng.choice(["agent-7", "desk9 z8", "ada"])
            parts.append(f"{head} {tail} end")
        texts.append(" ".join(parts))
    want = bootstrap(texts)
    got = {r.id: [(x.start, x.end) for x in r.learnt] for r in P.find_identifiers(docs(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want and any(want)


def bootstrap(texts, support=5, precision=0.8):
    """Contexts and instances of whole texts, scored in plain rounds."""
    import math

    known = lambda w: re.sub("#+", "#", re.sub("[0-9]", "#", w.lower()))
    edges, places, strings = {}, [], {}
    for text in texts:
        base, here = [x[1:] for x in brute(text)], []
        kinds = {x[1:]: x[0] for x in brute(text)}
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\S+", text)]
        names = ["^", "^", *[known(w[2]) for w in words]]
        before = lambda at: " ".join(names[sum(w[0] < at for w in words) :][:2])  # noqa: B023, E731
        for i in range(len(words)):
            strings[f"{names[i]} {names[i + 1]}"] = strings.get(f"{names[i]} {names[i + 1]}", 0) + 1
        for span in base:
            edges.setdefault((before(span[0]), text[span[0] : span[1]]), kinds[span])
        run = None
        for i, (a, b, w) in enumerate([*words, (0, 0, "")]):
            free = re.search("[0-9]", w) and not any(s < b and e > a for s, e in base)
            if run is not None and not free:
                here.append((run[0], run[1], before(run[0]), text[run[0] : run[1]]))
                run = None
            if free:
                run = (a, b) if run is None else (run[0], b)
            elif w and not re.search("[0-9]", w) and not re.search(SHAPES["email"], w):
                here.append((a, b, f"{names[i]} {names[i + 1]}", w))
        for _, _, c, x in here:
            edges.setdefault((c, x), None)
        places.append(here)
    seeds = {x: k for (_, x), k in edges.items() if k}
    scores, last = {(x, k): 1.0 for x, k in seeds.items()}, None
    while True:
        sums, count = {}, {}
        for c, x in edges:
            count[c] = count.get(c, 0) + 1
            for (y, k), v in scores.items():
                if y == x:
                    sums[c, k] = sums.get((c, k), 0) + v
        top = {}
        for (c, k), v in sums.items():
            if v >= support:
                top[c] = max(top.get(c, 0), v)
        good = {
            (c, k): v / count[c]
            for (c, k), v in sums.items()
            if v >= support and strings.get(c, 0) <= top[c] * P.RARITY and v / count[c] >= precision
        }
        if not good or last is not None and set(good) <= last:
            break
        last = set(good)
        gained = {}
        for c, x in edges:
            for (d, k), p in good.items():
                if d == c and x not in seeds:
                    gained[x, k] = gained.get((x, k), 0) + math.log1p(-min(p, 0.999))
        scores = {(x, k): 1.0 for x, k in seeds.items()} | {y: 1 - math.exp(v) for y, v in gained.items()}
    trusted = {c for c, _ in good}
    return [[(a, b) for a, b, c, _ in here if c in trusted] for here in places]
