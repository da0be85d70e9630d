import datetime
import glob
import random

import pytest
from helpers import envelope_rows
from pyspark.sql import functions as F

from ripplelog.functions.times import minute_start, unix_seconds, utc_date, utc_timestamp
from ripplelog.operators import olap as O
from ripplelog.sinks.olap import (
    events_table,
    latest_stored,
    newest_batches,
    quarantine,
    write_events,
    write_events_ordered,
    write_tolerant,
)
from ripplelog.sources.log import TooManyBrokenMessages


def at(*parts):
    return datetime.datetime(*parts)


def test_times_do_not_depend_on_the_zone(spark):
    moments = [0, 1782777590, 1782777630, 1710054000, 1_782_669_720_000, 2**62]
    rows = spark.createDataFrame([(m,) for m in moments], "t bigint")
    got = rows.select(
        utc_date(F.col("t")).alias("d"),
        utc_timestamp(F.col("t")).alias("ts"),
        minute_start(utc_timestamp(F.col("t"))).alias("m"),
        unix_seconds(utc_timestamp(F.col("t"))).alias("s"),
    ).collect()
    assert [str(r.d) for r in got[:3]] == ["1970-01-01", "2026-06-29", "2026-06-30"]
    # 2024-03-10 07:00 UTC is the hour New York skips.
    assert (got[3].ts, got[3].s) == (at(2024, 3, 10, 7, 0, 0), 1710054000)
    assert got[1].m == at(2026, 6, 29, 23, 59)
    assert str(got[4].d) == "9999-12-31"
    assert [r.ts for r in got[4:]] == [at(2106, 2, 7, 6, 28, 15)] * 2
    gap = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.5' AS ts").select(unix_seconds(F.col("ts")))
    assert gap.collect()[0][0] == 1710037800


def test_dashboard(spark, tmp_path):
    rows = [
        ("a", "enwiki", "T1", "u1", False, 60),
        ("a", "enwiki", "T1", "u1", False, 60),
        ("b", "dewiki", "T2", "u2", True, 119),
        ("c", "enwiki", "T3", "u3", True, 240),
    ]
    events = envelope_rows(spark, rows).withColumn(
        "event_type", F.when(F.col("event_id") == "c", "log").otherwise("edit")
    )
    table = str(tmp_path / "events")
    stamped = O.olap_rows(
        events, "partition", "offset", ingested_at=utc_timestamp(F.col("occurred_at"))
    )
    write_events_ordered(stamped, table)
    stored = events_table(spark, table)
    assert O.total_events(stored).collect()[0].total == 4
    assert [tuple(r) for r in O.events_by_type(stored).collect()] == [("edit", 3), ("log", 1)]
    assert [tuple(r) for r in O.throughput(stored).collect()] == [
        (at(1970, 1, 1, 0, 1), 3),
        (at(1970, 1, 1, 0, 4), 1),
    ]
    assert [tuple(r) for r in O.top_wikis(stored, 1).collect()] == [("enwiki", 3)]
    latest = O.latest_events(stored, 2).collect()
    assert [(r.wiki, r.title) for r in latest] == [("enwiki", "T3"), ("dewiki", "T2")]


def test_ingest_time_defaults_to_now(spark):
    rows = O.olap_rows(envelope_rows(spark, [("a", "w", "t", "u", False, 1)]))
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((rows.collect()[0].ingested_at - now).total_seconds()) < 300


def stamped(spark, rows):
    """(offset, ingest second) pairs as table rows."""
    full = [(f"e{n}", "edit", "w", "t", "u", False, 5, at, 0, n, None, False) for n, at in rows]
    df = spark.createDataFrame(
        full,
        "event_id string, event_type string, wiki string, title string, user string, bot boolean, occurred_at bigint,"
        " at bigint, partition int, offset bigint, value binary, _broken boolean",
    )
    times = {"occurred_at": utc_timestamp(F.col("occurred_at")), "ingested_at": utc_timestamp(F.col("at"))}
    return df.withColumns(times).drop("at")


def test_newest_rows_open_only_the_batches_that_can_hold_them(spark, tmp_path):
    rng, table, rows = random.Random(6), str(tmp_path / "t"), []
    for batch in range(8):
        part = [(batch * 100 + n, batch * 1000 + rng.randrange(1300)) for n in range(rng.choice([1, 3, 20]))]
        rows += [(at, offset, batch) for offset, at in part]
        write_events(stamped(spark, part).drop("value", "_broken"), table, batch)
    for n in (1, 4, 30, 500):
        newest = sorted(rows, reverse=True)[:n]
        names = newest_batches(spark, table, n)
        assert {batch for _, _, batch in newest} <= set(names)
        if n < 5:
            assert len(names) < 5
        found = latest_stored(spark, table, n)
        opened = {int(f.split("batch_id=")[1].split("/")[0]) for f in found.inputFiles()}
        assert opened == set(names) and found.count() == len(newest)
    again = stamped(spark, [(900, 99_000)]).drop("value", "_broken")
    for _ in range(2):
        write_events(again, table, 3)  # a retried batch replaces rows and zone
    assert newest_batches(spark, table, 1) == [3]


def test_tolerance_is_decided_before_anything_is_seen(spark, tmp_path):
    def batch(broken, first):
        rows = stamped(spark, [(first + n, 10) for n in range(5 + broken)])
        bad = F.col("offset") >= first + 5
        value = F.when(bad, F.concat(F.lit("bad"), F.col("offset").cast("string"))).cast("binary")
        return rows.withColumns({"_broken": bad, "value": value})

    table = str(tmp_path / "t")
    assert write_tolerant(batch(10, 0), table, 0, 10) == (5, 10)
    assert write_tolerant(batch(10, 0), table, 0, 10) == (5, 10)  # a retry
    with pytest.raises(TooManyBrokenMessages, match="11 broken messages"):
        write_tolerant(batch(11, 100), table, 1, 10)
    assert write_tolerant(batch(0, 200), table, 2, 0) == (5, 0)
    assert sorted(r.offset for r in events_table(spark, table).collect()) == [*range(5), *range(200, 205)]
    aside = spark.read.parquet(quarantine(table)).collect()
    assert sorted(bytes(r.value) for r in aside) == sorted(f"bad{n}".encode() for n in range(5, 15))
    assert not glob.glob(f"{table}_aside/*")
    assert write_tolerant(batch(0, 300).where("false"), table, 3, 0) == (0, 0)
    assert newest_batches(spark, table, 100) == [0, 2]
