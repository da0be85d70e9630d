"""Read model: deduplicated events, page activity, wiki statistics and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = ("partition", "offset")

PAGE_KEY = ["wiki", "title"]
PAGE_COLUMNS = ["wiki", "title", "edit_count", "bot_edit_count", "last_event_at", "last_user"]
WIKI_KEY = ["wiki"]
WIKI_COLUMNS = ["wiki", "total_events", "bot_events", "human_events", "last_event_at"]


def bot_inc(bot: str = "bot") -> Column:
    return F.col(bot).cast("bigint")


def human_inc(bot: str = "bot") -> Column:
    return F.lit(1).cast("bigint") - bot_inc(bot)


def dedupe(events: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """One row per ``event_id``, the first to arrive.

    The minimum of a struct that starts with the arrival position is a partial aggregate: each
    task reduces its copies to one before the shuffle, so many copies of one id stay cheap. A
    window would send all of them to one task. Select the needed columns first: all others
    travel in the struct.
    """
    rest = [name for name in events.columns if name not in (*arrival, "event_id")]
    first = F.min(F.struct(*arrival, *rest)).alias("_first")
    return events.groupBy("event_id").agg(first).select("event_id", "_first.*").select(events.columns)


def processed_events(events: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Ledger of applied events: id and the event's own time."""
    slim = events.select("event_id", "occurred_at", *arrival)
    return dedupe(slim, arrival).select("event_id", F.col("occurred_at").alias("processed_at"))


def new_events(batch: DataFrame, ledger: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """First arrivals in the batch that the ledger does not hold yet.

    Dedupe runs first and leaves the batch partitioned by ``event_id``, which the anti join
    reuses, so the batch is shuffled once. Spark picks a broadcast by size on its own.
    """
    return dedupe(batch, arrival).join(ledger.select("event_id"), "event_id", "left_anti")


def page_activity(
    events: DataFrame, arrival: tuple[str, ...] = ARRIVAL, also: Sequence[Column] = ()
) -> DataFrame:
    """Per page: edits, bot edits, latest event time, and the user of the last arrived event."""
    return events.groupBy(*PAGE_KEY).agg(
        F.count(F.lit(1)).alias("edit_count"),
        F.sum(bot_inc()).alias("bot_edit_count"),
        F.max("occurred_at").alias("last_event_at"),
        F.max_by("user", F.struct(*arrival)).alias("last_user"),
        *also,
    )


def wiki_stats(events: DataFrame) -> DataFrame:
    """Per wiki: all, bot and human events, and the latest event time."""
    return events.groupBy(*WIKI_KEY).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum(bot_inc()).alias("bot_events"),
        F.sum(human_inc()).alias("human_events"),
        F.max("occurred_at").alias("last_event_at"),
    )


def counts(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: pages tracked and events processed."""
    one = lambda page: F.lit(page).alias("page")
    both = pages.select(one(1)).union(ledger.select(one(0)))
    return both.agg(
        F.count_if(F.col("page") == 1).alias("pages"),
        F.count_if(F.col("page") == 0).alias("processed_events"),
    )


def counts_of_events(events: DataFrame) -> DataFrame:
    """:func:`counts` from deduplicated events in one pass over them.

    Events are counted per page first, so what reaches the single final row is one row per page.
    """
    per_page = events.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("edits"))
    return per_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum("edits"), F.lit(0).cast("bigint")).alias("processed_events"),
    )


def get_page(pages: DataFrame, wiki: str, title: str) -> DataFrame:
    """The row of one page, or no row."""
    return pages.where((F.col("wiki") == wiki) & (F.col("title") == title))


def top_pages(pages: DataFrame, n: int = 10) -> DataFrame:
    """Most edited pages first."""
    order = [F.desc("edit_count"), F.asc("wiki"), F.asc("title")]
    return pages.select(PAGE_COLUMNS).orderBy(*order).limit(n)


def wiki_stats_ranked(stats: DataFrame) -> DataFrame:
    """Busiest wiki first."""
    return stats.select(WIKI_COLUMNS).orderBy(F.desc("total_events"), F.asc("wiki"))


def inspect(pages: DataFrame, stats: DataFrame, ledger: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """The read-model report: counts, top pages and wiki statistics."""
    return {
        "counts": counts(pages, ledger),
        "top": top_pages(pages, n),
        "stats": wiki_stats_ranked(stats),
    }
