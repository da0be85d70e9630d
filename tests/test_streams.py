import glob
import os
import random
import time

import pyarrow.parquet as pq
import pytest
from helpers import payload, raw_rows, validated_messages
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions.times import utc_timestamp
from ripplelog.operators import readmodel as R
from ripplelog.operators.decode import decode_envelope
from ripplelog.plans import catalog
from ripplelog.sinks.log import append_log, mirror_log
from ripplelog.sinks.olap import events_table
from ripplelog.sources.lake import backup_lines, lake
from ripplelog.sources.log import log_batch, log_stream
from ripplelog.streaming import consumers as C
from ripplelog.streaming import projector as P
from ripplelog.streaming import progress as G
from ripplelog.streaming.panels import start_throughput, throughput_now
from ripplelog.streaming.runner import EveryN, consume, counted, drain, metrics, run_for, trigger_for


def edit(event_id, title="Go", user="u", bot=False, at=100):
    return (event_id, "enwiki", title, user, bot, at)


def append(spark, root, segment, rows):
    append_log(validated_messages(spark, rows), root, segment, ["n"])


def page(spark, model, title="Go"):
    rows = R.get_page(P.current(spark, model, "page_activity"), "enwiki", title).collect()
    return tuple(rows[0])[2:] if rows else None


def test_read_model_lifecycle(spark, tmp_path):
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    append(spark, root, "a", [edit("k1", "Lake", "nils", at=60), edit("k2", "Hill", "ida", True, 800)])
    assert P.project(spark, root, model) == {"applied": 2, "skipped": 0}
    assert page(spark, model, "Lake") == (1, 0, 60, "nils")

    # Copies of a known id with other content, in a later run: skipped.
    append(spark, root, "b", [edit("k1", "Lake", "other", True, 990), edit("k2", "Lake", "other", at=1)])
    assert P.project(spark, root, model) == {"applied": 0, "skipped": 2}
    assert page(spark, model, "Lake") == (1, 0, 60, "nils")

    # New events count, also late ones; an older time does not lower the latest one.
    append(spark, root, "c", [edit("k3", "Lake", "robot", True, 75), edit("k4", "Hill", "eva", at=3)])
    assert P.project(spark, root, model) == {"applied": 2, "skipped": 0}
    assert page(spark, model, "Lake") == (2, 1, 75, "robot")
    assert page(spark, model, "Hill") == (2, 1, 800, "eva")
    report = P.inspect(spark, model)
    assert tuple(report["counts"].collect()[0]) == (2, 4)
    assert [tuple(s) for s in report["stats"].collect()] == [("enwiki", 4, 2, 2, 800)]
    assert G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] == 0

    # Stream, batch and replay agree.
    live = {name: sorted(P.current(spark, model, name).collect()) for name in ("page_activity", "wiki_stats")}
    batch = P.rebuild_batch(spark, root)
    assert {name: sorted(df.collect()) for name, df in batch.items()} == live
    P.rebuild(spark, root, model)
    assert {name: sorted(P.current(spark, model, name).collect()) for name in live} == live

    # Folding the changelog changes nothing, and later batches still count.
    P.compact(spark, model, "page_activity")
    assert sorted(P.current(spark, model, "page_activity").collect()) == live["page_activity"]
    append(spark, root, "d", [edit("k5", "Lake", "ulf", at=2)])
    P.project(spark, root, model)
    assert page(spark, model, "Lake") == (3, 1, 75, "ulf")
    P.compact(spark, model, "page_activity")
    assert page(spark, model, "Lake") == (3, 1, 75, "ulf")

    assert P.reset(spark, model, root) is True
    assert P.reset(spark, model, root) is False
    lag = G.group_lag(spark, root)
    assert lag.agg(F.sum("lag")).collect()[0][0] == 7


def test_counters_and_lag_cover_all_batches(spark, tmp_path):
    """Also those that Spark no longer reports, and also while the projector runs."""
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    for number in range(5):
        append(spark, root, f"s{number}", [edit(f"e{number}-{n}", f"T{n}") for n in range(3)] + [edit("same")])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        counts = P.project(spark, root, model, max_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert counts == {"applied": 16, "skipped": 4}
    assert P.applied_counts(spark, model).count() > 3
    assert G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] == 0
    append(spark, root, "more", [edit("new", "T0")])
    assert G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] == 1
    query = P.start_projector(spark, root, model, trigger=trigger_for(1), state_partitions=2)
    deadline = time.time() + 60
    while G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] and time.time() < deadline:
        time.sleep(0.5)
    assert query.isActive and G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] == 0
    query.stop()


def test_first_copy_wins_inside_one_batch(spark, tmp_path):
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    copies = [edit("hot", user=f"w{n}", at=400 - n) for n in range(50)]
    append(spark, root, "a", [edit("cold", user="zoltan", at=9), *copies])
    assert P.project(spark, root, model) == {"applied": 2, "skipped": 49}
    assert page(spark, model) == (2, 0, 400, "w0")


def test_stores_do_not_track_their_rows(spark, tmp_path):
    """They would read each key once more before they write it; ``state_sizes`` counts rows when asked."""
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    append(spark, root, "a", [edit(f"e{n}") for n in range(1000)])
    query = P.start_projector(spark, root, model)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsUpdated"] > 1000
    assert state["numRowsTotal"] <= 0
    assert P.state_sizes(spark, model).agg(F.sum("rows")).first()[0] == state["numRowsUpdated"]


def test_uncommitted_batch_is_invisible(spark, tmp_path):
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    append(spark, root, "a", [edit("e1")])
    P.project(spark, root, model)
    # What a batch leaves behind that stopped before its commit row.
    half = P.current(spark, model, "page_activity").selectExpr("*", "0 AS partition", "9L AS offset")
    half.write.parquet(model.batch("page_activity", 1))
    assert page(spark, model) == (1, 0, 100, "u")
    assert P.ledger(spark, model).count() == 1


def raw_topic(spark, root, payloads):
    rows = raw_rows(spark, payloads).withColumn("n", F.col("offset"))
    append_log(rows.select("key", "value", "topic", "n"), root, "seed", ["n"])


def test_validator_routes_and_resumes(spark, tmp_path):
    root, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    raw_topic(spark, root, [payload(), "junk", payload(meta_id=""), payload(meta_id="e-2")])
    drain(C.validator(spark, root, checkpoint))
    drain(C.validator(spark, root, checkpoint))
    valid = decode_envelope(log_batch(spark, root, S.TOPIC_VALIDATED), "offset", "key").orderBy("offset")
    assert [(r.event_id, r.offset) for r in valid.collect()] == [("e-1", 0), ("e-2", 1)]
    dead = log_batch(spark, root, S.TOPIC_DEAD_LETTER).orderBy("offset").collect()
    assert [r.offset for r in dead] == [0, 1] and b"junk" in bytes(dead[0].value)
    assert G.group_lag(spark, root, S.GROUP_VALIDATOR, S.TOPIC_RAW).agg(F.sum("lag")).collect()[0][0] == 0


def test_other_sources_and_sinks(spark, tmp_path):
    root = str(tmp_path / "log")
    raw_topic(spark, root, [payload(), "junk"])
    out = []
    source = log_stream(spark, root, S.TOPIC_RAW)
    drain(
        C.validator(
            spark,
            str(tmp_path / "progress"),
            str(tmp_path / "cp"),
            source=source,
            append=lambda rows: out.extend(r.topic for r in rows.collect()),
        )
    )
    assert sorted(out) == sorted([S.TOPIC_VALIDATED, S.TOPIC_DEAD_LETTER])


def test_independent_consumers(spark, tmp_path):
    root = str(tmp_path / "log")
    append(spark, root, "a", [edit(f"e{n}", f"T{n}", at=86_400 * (n % 3) + 1) for n in range(30)])
    here = lambda name: str(tmp_path / name)
    for _ in range(2):  # the second round finds nothing new
        drain(
            C.archiver(spark, root, here("backup"), here("cp1")),
            C.laker(spark, root, here("lake"), here("cp2")),
            C.ingest_events(spark, root, here("events"), here("cp3")),
        )
    values = {bytes(r.value).decode() for r in log_batch(spark, root).collect()}
    assert {r.value for r in backup_lines(spark, here("backup")).collect()} == values
    assert lake(spark, here("lake")).groupBy("dt").count().count() == 3
    assert events_table(spark, here("events")).count() == 30
    for group in (S.GROUP_BACKUP, S.GROUP_LAKE, S.GROUP_OLAP):
        assert G.group_lag(spark, root, group).agg(F.sum("lag")).collect()[0][0] == 0
    assert G.group_lag(spark, root).agg(F.sum("lag")).collect()[0][0] == 30


def test_poison_policies(spark, tmp_path):
    root = str(tmp_path / "log")
    append(spark, root, "a", [edit("e1")])
    bad = validated_messages(spark, [edit(f"x{n}") for n in range(11)])
    append_log(bad.withColumn("value", F.lit(b"{oops")), root, "b", ["n"])
    with pytest.raises(Exception, match="malformed"):
        P.project(spark, root, P.ReadModel(str(tmp_path / "model")))
    with pytest.raises(Exception, match="broken messages"):
        drain(C.ingest_events(spark, root, str(tmp_path / "t1"), str(tmp_path / "cp1")))
    drain(C.ingest_events(spark, root, str(tmp_path / "t2"), str(tmp_path / "cp2"), max_broken=11))
    assert events_table(spark, str(tmp_path / "t2")).count() == 1


def test_progress_moves_only_after_the_handler(spark, tmp_path):
    root, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    append(spark, root, "a", [edit(f"e{n}") for n in range(5)])
    seen = []

    def failing(batch, batch_id):
        raise RuntimeError("sink down")

    def working(batch, batch_id):
        seen.append((batch_id, batch.count()))

    stream = log_stream(spark, root, S.TOPIC_VALIDATED)
    with pytest.raises(Exception, match="sink down"):
        drain(consume(stream, failing, checkpoint, group="g", log_root=root))
    assert G.group_lag(spark, root, "g").agg(F.sum("lag")).collect()[0][0] == 5
    drain(consume(stream, working, checkpoint, group="g", log_root=root))
    assert seen == [(0, 5)]
    assert G.group_lag(spark, root, "g").agg(F.sum("lag")).collect()[0][0] == 0


def test_lag_is_what_was_not_read(spark, tmp_path):
    """Also when a batch of a few files leaves out lower offsets, and on any number of partitions."""
    root = str(tmp_path)
    rows = validated_messages(spark, [edit(f"e{n}", f"T{n}") for n in range(90)])
    wide = {S.TOPIC_VALIDATED: 11}
    append_log(rows.withColumn("chunk", F.floor(F.col("n") / 9)), root, "a", ["n"], ["chunk"], partitions=wide)
    seen, lags = [], []

    def handle(batch, batch_id):
        seen.append(batch.count())

    stream = log_stream(spark, root, S.TOPIC_VALIDATED, max_per_trigger=2)
    drain(consume(stream, handle, str(tmp_path / "cp"), group="slow", log_root=root))
    for number in range(len(seen)):
        lags.append(G.group_lag(spark, root, "slow", up_to_batch=number).agg(F.sum("lag")).collect()[0][0])
    assert len(seen) > 2 and lags == [90 - sum(seen[: n + 1]) for n in range(len(seen))]
    history = G.lag_after_batches(spark, root, "slow", S.TOPIC_VALIDATED).orderBy("batch_id").collect()
    assert [r.total_lag for r in history] == lags
    assert G.group_lag(spark, root, "slow").count() == 11


def test_lag_on_offsets_with_gaps_and_files_out_of_order(spark, tmp_path):
    """Against the offsets themselves, after each of many batches."""
    root, rng = str(tmp_path / "log"), random.Random(8)
    offsets = sorted(rng.sample(range(50, 5000), 300))
    seen = []
    for number, part in enumerate((offsets[:140], offsets[140:260], offsets[260:])):
        rows = validated_messages(spark, [edit(f"g{o}") for o in part]).drop("n")
        places = spark.createDataFrame([(f"g{o}", o % 2, o) for o in part], "id string, partition int, offset bigint")
        event = F.get_json_object(rows["value"].cast("string"), "$.event_id")
        rows = rows.withColumn("id", event).join(places, "id").drop("id").repartition(5)
        mirror_log(rows, root, f"m{number}")
        mirror_log(rows, root, f"m{number}")  # does nothing

    def handle(batch, batch_id):
        seen.append({r.offset for r in batch.select("offset").collect()})

    stream = log_stream(spark, root, S.TOPIC_VALIDATED, 2, segments=True)
    drain(consume(stream, handle, str(tmp_path / "cp"), group="g", log_root=root))
    assert len(seen) > 4 and sum(map(len, seen)) == 300
    for number in range(len(seen)):
        done = set().union(*seen[: number + 1])
        lag = {r.partition: r for r in G.group_lag(spark, root, "g", up_to_batch=number).collect()}
        behind = {r.partition: r.lag for r in G.offset_lag(spark, root, "g", up_to_batch=number).collect()}
        for p in (0, 1):
            own = [o for o in offsets if o % 2 == p]
            first = next((o for o in own if o not in done), own[-1] + 1)
            assert lag[p].lag == sum(o not in done for o in own) and lag[p].high == own[-1] + 1
            # Never beyond the first row that is left; there at the end.
            assert lag[p].committed <= first and behind[p] == lag[p].high - lag[p].committed
    assert [lag[p].committed == lag[p].high and lag[p].lag == behind[p] == 0 for p in (0, 1)] == [True, True]


def test_kafka_lag_of_a_progress_report():
    report = {
        "sources": [
            {"description": "FileStreamSource[x]", "endOffset": {"logOffset": 3}},
            {
                "description": "KafkaV2[Subscribe[t]]",
                "endOffset": '{"t":{"0":40,"2":-1}}',
                "latestOffset": {"t": {"0": 90, "1": 7, "2": 5}},
            },
        ]
    }
    assert G.kafka_lag(report) == [("t", 0, 40, 90, 50), ("t", 1, 0, 7, 7), ("t", 2, 0, 5, 5)]


def test_a_retried_append_is_read_once(spark, tmp_path):
    """A reader that saw a segment isn't disturbed when its writer appends it again."""
    root, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    seen = []
    rows = [edit(f"e{n}", f"T{n}") for n in range(12)]
    append(spark, root, "a", rows)
    for _ in range(2):
        drain(consume(log_stream(spark, root, S.TOPIC_VALIDATED), lambda b, n: seen.append(b.count()), checkpoint))
        append(spark, root, "a", rows)
    assert seen == [12]


def test_bounded_run_and_progress_reports(spark, tmp_path):
    root = str(tmp_path / "log")
    append(spark, root, "a", [edit(f"e{n}") for n in range(7)])
    reports = []
    listener = EveryN(3, lambda name, rows: reports.append(rows))
    spark.streams.addListener(listener)
    try:
        stream = counted(log_stream(spark, root, S.TOPIC_VALIDATED), "seen", odd=F.col("offset") % 2 == 1)
        writer = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
        query = writer.trigger(**trigger_for(1)).start()
        run_for(query, 6)
        assert not query.isActive and query.exception() is None
        assert metrics(query, "seen") == {"rows": 7, "odd": 3}
        deadline = time.time() + 10
        while not reports and time.time() < deadline:
            time.sleep(0.2)
        assert reports == [7]
    finally:
        spark.streams.removeListener(listener)


def test_observed_counters_cover_batches_that_spark_forgets(spark, tmp_path):
    root, usual = str(tmp_path / "log"), "spark.sql.streaming.numRecentProgressUpdates"
    for number in range(5):
        append(spark, root, f"s{number}", [edit(f"f{number}-{n}") for n in range(3)])
    spark.conf.set(usual, "2")
    try:
        stream = counted(log_stream(spark, root, S.TOPIC_VALIDATED, 1), "all", odd=F.col("offset") % 2 == 1)
        query = consume(stream, lambda batch, _: batch.count() and None, str(tmp_path / "c"))
        drain(query)
        assert len(query.recentProgress) <= 2
        assert metrics(query, "all") == {"rows": 15, "odd": 7}
    finally:
        spark.conf.unset(usual)


def test_running_throughput_counts_late_and_retried_rows_once(spark, tmp_path):
    root, panel, checkpoint = (str(tmp_path / name) for name in ("log", "panel", "cp"))
    minute = lambda s: utc_timestamp(F.col("occurred_at")) if s else None
    for number, times in enumerate(([60, 61, 119, 600], [62, 601, 3600], [60])):
        append(spark, root, f"s{number}", [edit(f"t{number}-{n}", at=at) for n, at in enumerate(times)])
        drain(start_throughput(spark, root, panel, checkpoint, ingested_at=minute(True)))
    bad = validated_messages(spark, [edit("x")]).withColumn("value", F.lit(b"{oops"))
    append_log(bad, root, "bad", ["n"])
    drain(start_throughput(spark, root, panel, checkpoint, ingested_at=minute(True)))
    # What a crash leaves and the retry of the batch replaces.
    again = spark.read.parquet(f"{panel}/batch_id=1").collect()
    spark.createDataFrame(again).write.mode("overwrite").parquet(f"{panel}/batch_id=1")
    got = [(r.time.hour * 60 + r.time.minute, r.events) for r in throughput_now(spark, panel).collect()]
    assert got == [(1, 5), (10, 2), (60, 1)]

    # With a bound, rows for minutes that have left the state are not counted.
    panel, checkpoint = str(tmp_path / "panel2"), str(tmp_path / "cp2")
    drain(start_throughput(spark, root, panel, checkpoint, ingested_at=minute(True), late="10 minutes", max_per_trigger=1))
    newest = {r.time.hour * 60 + r.time.minute: r.events for r in throughput_now(spark, panel).collect()}
    assert newest[60] == 1 and newest[1] <= 5


def test_state_audit_and_reshard(spark, tmp_path):
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    append(spark, root, "a", [edit(f"s{n}", f"T{n % 4}") for n in range(20)] + [edit("s3"), edit("s4")])
    P.project(spark, root, model, state_partitions=3)
    assert tuple(P.state_audit(spark, model).collect()[0]) == (20, 20, 0, 0)
    assert {r.partition_id for r in P.state_sizes(spark, model).collect()} <= {0, 1, 2}
    lost = spark.read.parquet(model.batch("applied", 0)).where("event_id <> 's7'").collect()
    spark.createDataFrame(lost, P.APPLIED).write.mode("overwrite").parquet(model.batch("applied", 0))
    assert tuple(P.state_audit(spark, model).collect()[0]) == (20, 19, 1, 0)
    P.rebuild(spark, root, model, state_partitions=2)
    assert tuple(P.state_audit(spark, model).collect()[0]) == (20, 20, 0, 0)
    assert {r.partition_id for r in P.state_sizes(spark, model).collect()} <= {0, 1}


def test_counters_survive_a_restart(spark, tmp_path):
    root, backup, checkpoint = (str(tmp_path / name) for name in ("log", "backup", "cp"))
    for number in range(2):
        append(spark, root, f"c{number}", [edit(f"c{number}-{n}", f"T{n}") for n in range(30)])
        drain(C.archiver(spark, root, backup, checkpoint, rows=8))
    totals = {r.name: r.value for r in G.counters(spark, root, S.GROUP_BACKUP).collect()}
    files = spark.read.text(f"{backup}/raw").inputFiles()
    assert totals == {"rows": 60, "flushes": 2, "objects": len(files)}
    raw_topic(spark, str(tmp_path / "raw"), [payload(), "junk", payload(meta_id="q")])
    drain(C.validator(spark, str(tmp_path / "raw"), str(tmp_path / "cp3")))
    totals = {r.name: r.value for r in G.counters(spark, str(tmp_path / "raw"), S.GROUP_VALIDATOR).collect()}
    assert totals == {"rows": 3, "flushes": 1, "validated": 2, "dead_lettered": 1}


def test_page_lookup_reads_the_row_groups_of_its_key(spark, tmp_path):
    root, model = str(tmp_path / "log"), P.ReadModel(str(tmp_path / "model"))
    append(spark, root, "a", [edit(f"p{n}", f"Title {n:04d}") for n in range(4000)])
    P.project(spark, root, model)
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "4096")
    hadoop.set("parquet.page.size", "1024")
    try:
        P.compact(spark, model, "page_activity")
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size")
    append(spark, root, "b", [edit("new", "Title 0042", "late", at=7)])
    P.project(spark, root, model)
    found = P.get_page(spark, model, "enwiki", "Title 0042")
    assert [tuple(r)[2:] for r in found.collect()] == [(2, 0, 100, "late")]
    assert P.get_page(spark, model, "enwiki", "Title 9").collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(title,Title 0042)") >= 2  # snapshot and later batches
    files = sorted(glob.glob(f"{model.snapshots('page_activity')}/upto=*/*.parquet"))
    spans = []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        column = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "title")
        spans += [(s.min, s.max) for s in (meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups))]
    assert len(spans) > 3 and sum(a <= "Title 0042" <= b for a, b in spans) == 1
    folder = glob.glob(f"{model.snapshots('page_activity')}/upto=*")[0]
    scan = spark.read.schema(P.TABLES["page_activity"].schema).parquet(folder).where("title = 'Title 0042'")
    assert scan.count() == 1
    sizes = [os.path.getsize(f) for f in files]
    plain = str(tmp_path / "plain")
    spark.read.parquet(folder).write.parquet(plain)
    assert sum(sizes) > sum(os.path.getsize(f) for f in glob.glob(f"{plain}/*.parquet"))  # the filters take room


def test_state_and_progress_keep_their_tasks(spark, tmp_path):
    """What is written last, few rows, must not draw the work before it into one task."""
    root, tracker = str(tmp_path / "log"), spark.sparkContext.statusTracker()
    append(spark, root, "a", [edit(f"e{n}", at=60 * n + 1) for n in range(40)])
    query = start_throughput(spark, root, str(tmp_path / "panel"), str(tmp_path / "checkpoint"))
    drain(query)
    stages = [i for job in tracker.getJobIdsForGroup(str(query.runId)) for i in tracker.getJobInfo(job).stageIds]
    assert max(info.numTasks for i in stages if (info := tracker.getStageInfo(i))) == 4  # the state's stores


def test_the_poison_message_is_sought_once(spark, tmp_path, monkeypatch):
    class Stop(Exception):
        pass

    def append(messages, *where, cache=False):
        assert cache and messages.count() == 1
        raise Stop

    append_log(validated_messages(spark, [(f"e{n}", "w", "t", "u", False, n + 1) for n in range(9)]), str(tmp_path), "a", ["n"])
    monkeypatch.setattr(catalog, "_projected", lambda *args: (str(tmp_path), None))
    monkeypatch.setattr(catalog, "append_log", append)
    with pytest.raises(Stop):
        catalog.registered()["poison_fails"](spark, "")


def test_a_commit_needs_no_python_worker(spark, tmp_path, monkeypatch):
    """Progress of a batch that holds one segment whole and one in part, with counters."""
    rows = [(S.TOPIC_RAW, p, n, seg) for p, n, seg in ((0, 0, "a"), (0, 1, "a"), (1, 5, "a"), (0, 2, "b"), (0, 4, "b"))]
    batch = spark.createDataFrame(rows, "topic string, partition int, offset bigint, segment string")
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    G.commit_progress(batch, str(tmp_path), "g", 7, {"objects": 3})
    got = G.progress(spark, str(tmp_path), "g").orderBy(F.col("partition"), "segment", "lo").collect()
    assert [(r.partition, r.segment, r.lo, r.hi, r.rows) for r in got] == [
        (None, None, None, None, None), (0, "a", 0, 1, 2), (0, "b", 2, 2, 1), (0, "b", 4, 4, 1), (1, "a", 5, 5, 1)
    ]
    assert got[0].counters == {"objects": 3} and {r.batch_id for r in got} == {7}
