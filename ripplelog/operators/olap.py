"""Analytics table rows and the dashboard queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.functions.times import minute_start, utc_now, utc_timestamp

SORT_KEY = ["occurred_at", "wiki"]


def olap_rows(envelopes: DataFrame, *keep: str, ingested_at: Column | None = None) -> DataFrame:
    """Envelope rows with event time as a timestamp and an ingest time (now unless given)."""
    return envelopes.select(
        "event_id",
        "event_type",
        "wiki",
        "title",
        "user",
        "bot",
        utc_timestamp(F.col("occurred_at")).alias("occurred_at"),
        (utc_now() if ingested_at is None else ingested_at).alias("ingested_at"),
        *keep,
    )


def total_events(events: DataFrame) -> DataFrame:
    """Number of rows; redelivered events count again."""
    return events.agg(F.count(F.lit(1)).alias("total"))


def events_by_type(events: DataFrame) -> DataFrame:
    """Rows per event type, busiest first."""
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("c"))
    return counted.orderBy(F.desc("c"), F.asc("event_type"))


def throughput(events: DataFrame) -> DataFrame:
    """Rows per ingest minute in time order; minutes without rows do not appear."""
    minute = minute_start(F.col("ingested_at")).alias("time")
    return events.groupBy(minute).agg(F.count(F.lit(1)).alias("events")).orderBy("time")


def top_wikis(events: DataFrame, n: int = 5) -> DataFrame:
    """Busiest wikis."""
    counted = events.groupBy("wiki").agg(F.count(F.lit(1)).alias("c"))
    return counted.orderBy(F.desc("c"), F.asc("wiki")).limit(n)


def latest_events(events: DataFrame, n: int = 10) -> DataFrame:
    """Rows ingested last; log position breaks ties."""
    order = [F.desc("ingested_at"), F.desc("partition"), F.desc("offset")]
    return events.orderBy(*order).limit(n).select("occurred_at", "wiki", "event_type", "user", "title")
