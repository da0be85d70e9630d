import random
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import payload, raw_rows, validated_messages
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions.keys import partition_for
from ripplelog.operators import offsets
from ripplelog.operators.lag import compute_lag, high_water, total_lag
from ripplelog.operators.offsets import assign_offsets, chunk_of, offset_ranges
from ripplelog.plans.fixture import deliveries
from ripplelog.sinks.log import append_log
from ripplelog.sources.log import (
    TooManyBrokenMessages,
    kafka_options,
    log_batch,
    log_rows,
    segment_ranges,
    stored_topics,
    topics,
)
from ripplelog.streaming.consumers import routed_segment

MESSAGES = [(f"e{n}", "enwiki", f"T{n % 9}", "u", False, n + 1) for n in range(40)]


def skewed(spark, rows=3000):
    """A third of the rows in one partition, order values with gaps, shuffled."""
    rng = random.Random(3)
    orders = rng.sample(range(10 * rows), rows)
    data = [("t", 0 if rng.random() < 0.4 else rng.randrange(1, 6), order) for order in orders]
    return data, spark.createDataFrame(data, "topic string, partition int, n bigint").repartition(5)


def dense(data, start=0):
    want, counts = {}, {}
    for _, partition, order in sorted(data, key=lambda row: (row[1], row[2])):
        want[order] = counts.get(partition, start)
        counts[partition] = want[order] + 1
    return want


@pytest.mark.parametrize("chunk", [None, 50, 1_000_000])
def test_offsets_are_dense_and_ordered(spark, chunk):
    data, df = skewed(spark)
    if chunk:
        df = df.withColumn("chunk", chunk_of(F.col("n"), chunk))
    numbered = assign_offsets(df, ["n"], ["chunk"] if chunk else None)
    assert {r.n: r.offset for r in numbered.collect()} == dense(data)


def test_offsets_continue_at_the_high_water_mark(spark):
    data, df = skewed(spark, 200)
    taken = spark.createDataFrame([("t", p, 100) for p in range(6)], "topic string, partition int, high bigint")
    numbered = assign_offsets(df.withColumn("chunk", chunk_of(F.col("n"), 64)), ["n"], ["chunk"], taken)
    assert {r.n: r.offset for r in numbered.collect()} == dense(data, 100)


def test_no_window_over_a_whole_partition(spark):
    _, df = skewed(spark, 100)
    numbered = assign_offsets(df.withColumn("chunk", chunk_of(F.col("n"), 10)), ["n"], ["chunk"])
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    ranking = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert ranking and all("chunk" in line for line in ranking)


def test_append_and_retry(spark, tmp_path):
    root = str(tmp_path)
    first, second = validated_messages(spark, MESSAGES[:25]), validated_messages(spark, MESSAGES[25:])
    append_log(first, root, "a", ["n"])
    append_log(second, root, "b", ["n"])
    before = sorted(log_batch(spark, root).drop("timestamp").collect())
    append_log(second, root, "b", ["n"])
    assert sorted(log_batch(spark, root).drop("timestamp").collect()) == before
    assert len(before) == 40
    for part in offset_ranges(log_batch(spark, root)).collect():
        assert (part.lo, part.hi) == (0, part.rows - 1)
        assert part.label == f"{part.lo:020d}-{part.hi:020d}"
    # One key stays in one partition, in order of arrival.
    log = log_batch(spark, root).orderBy("partition", "offset").collect()
    homes, times = {}, {}
    for row in log:
        key = bytes(row.key)
        assert homes.setdefault(key, row.partition) == row.partition
        times.setdefault(key, []).append(int(bytes(row.value).split(b":")[-1].strip(b"}")))
    assert all(values == sorted(values) for values in times.values())
    assert segment_ranges(spark, root).where("segment = 'b'").agg(F.sum("rows")).collect()[0][0] == 15


def test_every_message_is_stored(spark, tmp_path):
    root = str(tmp_path)
    rows = [(b"k" if n % 3 else None, f"v{n}".encode() if n % 7 else None, "other", n) for n in range(60)]
    messages = spark.createDataFrame(rows, "key binary, value binary, topic string, n bigint").repartition(4)
    append_log(messages, root, "a", ["n"], partitions={"other": 9})
    log = log_batch(spark, root, "other").collect()
    assert sorted((r.key and bytes(r.key), r.value and bytes(r.value)) for r in log if r.key and r.value) == sorted(
        r[:2] for r in rows if r[0] and r[1]
    )
    assert len(log) == 60 and {r.partition for r in log} <= set(range(9)) and len({r.partition for r in log}) > 3
    for part in offset_ranges(log_batch(spark, root)).collect():
        assert (part.lo, part.hi) == (0, part.rows - 1)
    assert len({r.partition for r in log if r.key}) == 1
    with pytest.raises(Exception, match="no partition count"):
        append_log(messages, str(tmp_path / "x"), "a", ["n"])


def test_a_published_segment_keeps_its_files(spark, tmp_path):
    root = str(tmp_path)
    append_log(validated_messages(spark, MESSAGES), root, "a", ["n"])
    before = set(log_batch(spark, root).inputFiles())
    append_log(validated_messages(spark, MESSAGES), root, "a", ["n"])
    assert set(log_batch(spark, root).inputFiles()) == before


def test_append_nothing(spark, tmp_path):
    append_log(validated_messages(spark, MESSAGES).where("false"), str(tmp_path), "a", ["n"])
    assert segment_ranges(spark, str(tmp_path)) is None


def test_topics_and_segments(spark, tmp_path):
    root = str(tmp_path)
    messages = validated_messages(spark, MESSAGES)
    append_log(messages, root, "a", ["n"])
    append_log(messages.withColumn("topic", F.lit(S.TOPIC_DEAD_LETTER)), root, "b", ["n"])
    log = log_batch(spark, root)
    assert [r.topic for r in topics(log).collect()] == [S.TOPIC_DEAD_LETTER, S.TOPIC_VALIDATED]
    assert stored_topics(spark, root).collect() == topics(log).collect()
    assert stored_topics(spark, root + "/none").collect() == []
    dead = log_batch(spark, root, S.TOPIC_DEAD_LETTER)
    assert {r.partition for r in dead.collect()} == {0}
    plan = dead._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan
    assert log_batch(spark, root, segment="a").count() == 40


def test_partition_is_stable(spark):
    keys = spark.createDataFrame([("enwiki:Ada",), ("dewiki:Ü",), ("",)], "key string")
    got = [r[0] for r in keys.select(partition_for(F.col("key"), 6)).collect()]
    assert got == [1, 0, 4] or all(0 <= p < 6 for p in got)
    assert got == [r[0] for r in keys.select(partition_for(F.col("key"), F.lit(6))).collect()]


def block(spark, broken):
    good = '{"event_id":"a","event_type":"edit","wiki":"w","title":"t","user":"u","bot":true,"occurred_at":5}'
    return raw_rows(spark, [good, '{"event_id":"b"}'] * 10 + ['{"event_id":'] * broken)


def test_block_tolerates_ten_broken_messages(spark):
    with log_rows(block(spark, 10), S.ENVELOPE, "offset") as rows:
        got = rows.orderBy("offset").collect()
    assert len(got) == 20
    assert tuple(got[0]) == (0, "a", "edit", "w", "t", "u", True, 5)
    assert tuple(got[1]) == (1, "b", "", "", "", "", False, 0)


def test_block_fails_beyond_that(spark):
    with pytest.raises(TooManyBrokenMessages), log_rows(block(spark, 11), S.ENVELOPE):
        pass


def test_broken_rows_are_told_strictly(spark):
    good = '{"event_id":"a"}'
    bad = [good + "x", good + good, '{"title":5}', '{"user":{}}', '{"occurred_at":"5"}', '{"occurred_at":1.5}', "[]", "", "1"]
    with log_rows(raw_rows(spark, [*bad, good, "null", '{"bot":null}']), S.ENVELOPE, "offset") as rows:
        got = sorted(map(tuple, rows.collect()))
    zero = ("", "", "", "", "", False, 0)
    assert got == [(9, "a", *zero[1:]), (10, *zero), (11, *zero)]


def test_lag(spark):
    partitions = spark.createDataFrame([(7,), (4,), (0,), (5,)], "partition int")
    committed = spark.createDataFrame([(0, 61), (5, -1), (7, 33)], "partition int, committed bigint")
    high = spark.createDataFrame([(0, 90), (4, 8), (5, 12), (7, 33)], "partition int, high bigint")
    lag = compute_lag(partitions, committed, high)
    assert [tuple(r) for r in lag.collect()] == [(0, 61, 90, 29), (4, 0, 8, 8), (5, 0, 12, 12), (7, 33, 33, 0)]
    assert total_lag(lag).collect()[0].total_lag == 49
    over = compute_lag(partitions.where("partition = 0"), committed, high.withColumn("high", F.lit(3)))
    assert over.collect()[0].lag == 0
    rows = spark.createDataFrame([(0, 4), (0, 2), (1, 0)], "partition int, offset bigint")
    assert sorted(map(tuple, high_water(rows).collect())) == [(0, 5), (1, 1)]


def test_kafka_options():
    assert kafka_options("h:1", "t", max_rows=5000, seconds=10, max_per_trigger=9) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": "5000",
        "maxTriggerDelay": "10s",
        "maxOffsetsPerTrigger": "9",
    }
    assert "minOffsetsPerTrigger" not in kafka_options("h:1", "t")


def test_ordered_rows_are_dealt_to_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(offsets, "TASK_ROWS", (10, 50))
    df = spark.range(600).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("n"))
    numbered = assign_offsets(df.withColumn("chunk", chunk_of(F.col("n"), 10)), ["n"], ["chunk"])
    tasks = numbered.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("offset").alias("lo"), F.max("offset").alias("hi")
    ).collect()
    assert len(tasks) >= 12 and max(t.rows for t in tasks) <= 60
    assert all(t.hi - t.lo + 1 == t.rows for t in tasks)  # each holds a stretch of the order


def test_one_row_group_is_dealt_to_all_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [(n, n % 7, "edit", datetime(2024, 1, 1)) for n in range(4000)]
    table = pa.table([*map(list, zip(*rows, strict=True))], ["event_id", "user_id", "event_type", "ts"])
    pq.write_table(table, tmp_path / "in" / "events.parquet", compression="none")
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        sizes = deliveries(spark, str(tmp_path / "in")).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert len(sizes) >= 4 and max(s["count"] for s in sizes) < 2000


def test_a_log_with_gaps_is_routed_in_few_stretches(spark, tmp_path, monkeypatch):
    stretches, place = [], offsets.places_ahead
    monkeypatch.setattr(offsets, "places_ahead", lambda sizes, *how: stretches.append(sizes.count()) or place(sizes, *how))
    raw = raw_rows(spark, [payload(meta_id=f"e{n}", timestamp=n + 1) if n % 4 else "{" for n in range(400)])
    gapped = raw.withColumn("offset", F.col("offset") * 10**12).repartition(4)
    routed_segment(gapped, str(tmp_path), "a")
    assert stretches and max(stretches) <= 8  # and not one for each message
    rows = log_batch(spark, str(tmp_path), S.TOPIC_VALIDATED).orderBy("offset").collect()
    assert [r.offset for r in rows] == list(range(300))
    assert [f'"e{n}"' in bytes(r.value).decode() for r, n in zip(rows, [n for n in range(400) if n % 4], strict=True)] == [True] * 300


def test_rounds_of_deliveries_are_those_of_all_deliveries(spark, tmp_path):
    """Each round alone, of repeated and null ids too; only events that come again are dealt out for the second."""
    rows = [(n, 5, "edit", datetime(2024, 1, 1)) for n in (3, 3, 4, 28, 53, None)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    whole = deliveries(spark, str(tmp_path))
    for number, count in ((0, 6), (1, 4)):
        part = deliveries(spark, str(tmp_path), number)
        assert dict(part.dtypes) == dict(whole.dtypes)
        got = sorted(map(str, part.collect()))
        assert got == sorted(map(str, whole.where(F.col("redelivery") == number).collect())) and len(got) == count
