import random
from collections import defaultdict

from helpers import envelope_rows

from ripplelog.operators import readmodel as R


def pages_by_hand(rows):
    """One event after the other, as a key-value store would apply them."""
    seen, pages = set(), {}
    for event_id, wiki, title, user, bot, time in rows:
        if event_id in seen:
            continue
        seen.add(event_id)
        edits, bots, last, _ = pages.get((wiki, title), (0, 0, 0, ""))
        pages[wiki, title] = (edits + 1, bots + bot, max(last, time), user)
    return pages, seen


def test_only_the_first_copy_of_an_id_counts(spark):
    copies = [("k7", "svwiki", "Lake", f"editor{n}", n % 2 == 1, 900 - n) for n in range(4)]
    page = R.page_activity(R.dedupe(envelope_rows(spark, copies))).collect()
    assert [tuple(p) for p in page] == [("svwiki", "Lake", 1, 0, 900, "editor0")]
    more = [*copies, ("k8", "svwiki", "Lake", "robot", True, 640)]
    page = R.page_activity(R.dedupe(envelope_rows(spark, more))).collect()
    assert [tuple(p) for p in page] == [("svwiki", "Lake", 2, 1, 900, "robot")]


def test_reports(spark):
    pages = {("svwiki", "Lake"): 3, ("svwiki", "Hill"): 1, ("ptwiki", "Rio"): 2, ("ptwiki", "Mar"): 2, ("ptwiki", "Sol"): 1}
    rows = [
        (f"{wiki}-{title}-{n}", wiki, title, "someone", n == 1, 70 * n + 5)
        for (wiki, title), edits in pages.items()
        for n in range(edits)
    ]
    events = R.dedupe(envelope_rows(spark, rows))
    tables = R.page_activity(events), R.wiki_stats(events), R.processed_events(events)
    report = R.inspect(*tables)
    assert tuple(report["counts"].collect()[0]) == (5, 9)
    # Most edits first, then by wiki and title.
    assert [(p.title, p.edit_count) for p in report["top"].collect()] == [
        ("Lake", 3), ("Mar", 2), ("Rio", 2), ("Sol", 1), ("Hill", 1)
    ]
    assert [tuple(s) for s in report["stats"].collect()] == [("ptwiki", 5, 2, 3, 75), ("svwiki", 4, 1, 3, 145)]
    assert tuple(R.counts_of_events(events).collect()[0]) == (5, 9)
    assert R.top_pages(tables[0], 2).count() == 2
    assert R.get_page(tables[0], "ptwiki", "Sol").collect()[0].edit_count == 1
    assert R.get_page(tables[0], "ptwiki", "Lake").count() == 0


def test_arrival_decides_the_user_and_time_the_latest_time(spark):
    times = [31, 77, 12, 50]
    rows = [(f"t{n}", "svwiki", "Lake", f"by{n}", False, time) for n, time in enumerate(times)]
    page = R.page_activity(envelope_rows(spark, rows)).collect()[0]
    assert (page.last_event_at, page.last_user) == (max(times), "by3")


def test_empty_input(spark):
    none = envelope_rows(spark, [("x", "w", "t", "u", False, 1)]).where("false")
    assert tuple(R.counts_of_events(none).collect()[0]) == (0, 0)
    assert R.page_activity(R.dedupe(none)).count() == 0


def test_random_events_against_one_by_one(spark):
    rng = random.Random(11)
    rows = [
        (
            # One id and one page hold about a third of the rows.
            "hot" if rng.random() < 0.33 else f"e{rng.randrange(300)}",
            rng.choice(["enwiki", "enwiki", "dewiki"]),
            rng.choice(["Hot", "Hot", "A", "B", "C"]),
            f"u{rng.randrange(9)}",
            rng.random() < 0.4,
            rng.randrange(1, 1000),
        )
        for _ in range(2000)
    ]
    pages, seen = pages_by_hand(rows)
    events = R.dedupe(envelope_rows(spark, rows).repartition(7))
    got = {(p.wiki, p.title): tuple(p)[2:] for p in R.page_activity(events).collect()}
    assert got == pages
    assert {r.event_id for r in R.processed_events(events).collect()} == seen
    totals = defaultdict(int)
    for (wiki, _), page in pages.items():
        totals[wiki] += page[0]
    stats = {s.wiki: s for s in R.wiki_stats(events).collect()}
    assert {wiki: s.total_events for wiki, s in stats.items()} == totals
    assert all(s.bot_events + s.human_events == s.total_events for s in stats.values())


def test_new_events(spark):
    ledger = envelope_rows(spark, [("a", "w", "t", "u", False, 1)])
    batch = envelope_rows(
        spark,
        [("a", "w", "t", "x", False, 2), ("b", "w", "t", "y", False, 3), ("b", "w", "t", "z", False, 4)],
    )
    fresh = R.new_events(batch, R.processed_events(ledger)).collect()
    assert [(r.event_id, r.user) for r in fresh] == [("b", "y")]


def test_hot_keys_are_combined_before_the_shuffle(spark):
    events = envelope_rows(spark, [("a", "w", "t", "u", False, 1)])
    for result in (R.dedupe(events), R.page_activity(events), R.wiki_stats(events)):
        plan = result._jdf.queryExecution().sparkPlan().toString()
        assert "partial_" in plan and "Window" not in plan
