"""Registered queries: each operator over the whole derived log of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions.keys import partition_for
from ripplelog.functions.times import utc_now, utc_timestamp
from ripplelog.operators import lag as L
from ripplelog.operators import olap as O
from ripplelog.operators import readmodel as R
from ripplelog.operators.decode import (
    classify,
    decode_envelope,
    decode_raw,
    encode,
    text,
    to_dead_letter,
    to_envelope,
    with_page_key,
)
from ripplelog.operators.offsets import offset_ranges
from ripplelog.operators.routing import keyable, route
from ripplelog.plans import fixture as X
from ripplelog.session import configure, workspace
from ripplelog.sinks.log import append_log
from ripplelog.sinks.objects import kept, restore, write_backup, write_lake
from ripplelog.sinks.olap import events_table, latest_stored, quarantine, write_events_ordered
from ripplelog.sources import lake as K
from ripplelog.sources.log import log_batch, log_stream, stored_topics
from ripplelog.sources.sse import sse_capture
from ripplelog.streaming import consumers as C
from ripplelog.streaming import projector as P
from ripplelog.streaming import progress as G
from ripplelog.streaming.panels import start_throughput, throughput_now
from ripplelog.streaming.runner import EveryN, consume, drain, run_for, trigger_for

Query = Callable[[SparkSession, str], DataFrame]

# Objects of a batch backfill cover more offsets than those of a micro-batch.
BACKFILL_ROWS = 5_000_000

# A day of the test data, for the partition-pruned lake query.
LAKE_DAY = "2024-01-15"

_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _REGISTRY[function.__name__] = run
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.events_of(X.raw_log(spark, sf_dir))


_PAGE_INPUT = ["wiki", "title", "user", "bot", "occurred_at"]


def _unique(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Deduplicated events with just these columns: what dedupe shuffles is not pruned later."""
    return R.dedupe(_events(spark, sf_dir).select("event_id", *columns, *R.ARRIVAL))


# Decode, validate, route


@_query
def top_pages(spark, sf_dir):
    return R.top_pages(R.page_activity(_unique(spark, sf_dir, _PAGE_INPUT)))


@_query
def page_key(spark, sf_dir):
    return with_page_key(X.raw_log(spark, sf_dir)).select("event_id", "redelivery", "page_key")


@_query
def keyable_events(spark, sf_dir):
    return keyable(X.raw_log(spark, sf_dir)).select("page_key", text(F.col("value")).alias("value"))


@_query
def decoded_events(spark, sf_dir):
    decoded = decode_raw(X.raw_log(spark, sf_dir)).where("decode_ok")
    return decoded.select(
        F.col("event.id").alias("id"),
        F.col("event.meta.domain").alias("domain"),
        F.col("event.comment").alias("comment"),
        F.col("event.minor").alias("minor"),
        F.col("event.length.new").alias("length_new"),
        F.col("event.revision.old").alias("revision_old"),
    )


@_query
def validated_envelopes(spark, sf_dir):
    return to_envelope(classify(X.raw_log(spark, sf_dir)))


@_query
def encoded_envelopes(spark, sf_dir):
    envelopes = to_envelope(classify(X.raw_log(spark, sf_dir)))
    return envelopes.select(encode(*S.ENVELOPE_COLUMNS).alias("value"))


@_query
def dead_letters(spark, sf_dir):
    return to_dead_letter(classify(X.dense_log(spark, sf_dir)))


@_query
def dead_letter_reasons(spark, sf_dir):
    rejected = classify(X.raw_log(spark, sf_dir)).where(F.col("reason").isNotNull())
    return rejected.groupBy("reason", "error_class").agg(F.count(F.lit(1)).alias("rows"))


@_query
def route_counts(spark, sf_dir):
    return route(X.raw_log(spark, sf_dir)).groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


# Read model


@_query
def wiki_stats(spark, sf_dir):
    return R.wiki_stats_ranked(R.wiki_stats(_unique(spark, sf_dir, ["wiki", "bot", "occurred_at"])))


@_query
def read_model_counts(spark, sf_dir):
    return R.counts_of_events(_unique(spark, sf_dir, ["wiki", "title"]))


@_query
def processed_events(spark, sf_dir):
    return R.processed_events(_events(spark, sf_dir))


@_query
def page_activity(spark, sf_dir):
    return R.page_activity(_unique(spark, sf_dir, _PAGE_INPUT))


@_query
def page_lookup(spark, sf_dir):
    return R.get_page(R.page_activity(_unique(spark, sf_dir, _PAGE_INPUT)), "enwiki", "Page 0")


@_query
def new_events_anti_join(spark, sf_dir):
    """Whole log against a ledger that knows the events of the first half month."""
    batch = _events(spark, sf_dir).select("event_id", "wiki", "title", "occurred_at", *R.ARRIVAL)
    ledger = R.processed_events(batch.where(F.col("occurred_at") < 1_705_276_800))
    return R.new_events(batch, ledger).select("event_id", "wiki", "title", "occurred_at")


# Analytics table


def _olap(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = _events(spark, sf_dir)
    return O.olap_rows(
        envelopes, "partition", "offset", ingested_at=utc_timestamp(F.col("occurred_at"))
    )


@_query
def total_events(spark, sf_dir):
    return O.total_events(_olap(spark, sf_dir))


@_query
def events_by_type(spark, sf_dir):
    return O.events_by_type(_olap(spark, sf_dir))


@_query
def throughput_per_minute(spark, sf_dir):
    return O.throughput(_olap(spark, sf_dir))


@_query
def top_wikis(spark, sf_dir):
    return O.top_wikis(_olap(spark, sf_dir))


@_query
def latest_events(spark, sf_dir):
    return O.latest_events(_olap(spark, sf_dir))


@_query
def events_table_since(spark, sf_dir):
    """Sorted table written and read back; the time predicate reaches the Parquet row groups."""
    table = workspace(spark, "events-table")
    write_events_ordered(_olap(spark, sf_dir), table)
    rows = events_table(spark, table).where("occurred_at >= TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    return rows.groupBy("wiki", "event_type").agg(
        F.count(F.lit(1)).alias("c"), F.max("occurred_at").alias("last_at")
    )


# Log


@_query
def partition_assignment(spark, sf_dir):
    pages = X.deliveries(spark, sf_dir).groupBy("page").agg(F.count(F.lit(1)).alias("rows"))
    return pages.withColumn("partition", partition_for(F.col("page"), 6))


@_query
def offset_ranges_per_partition(spark, sf_dir):
    return offset_ranges(X.dense_log(spark, sf_dir))


def _routed_log(spark: SparkSession, sf_dir: str, segments: int = 1) -> str:
    """File log with the raw topic and, routed in one batch per segment, the two others."""
    root = workspace(spark, "log")
    X.write_raw_topic(spark, sf_dir, root, segments)
    for number in range(segments):
        raw = log_batch(spark, root, S.TOPIC_RAW, f"seed-{number}")
        C.routed_segment(raw, root, f"routed-{number}")
    return root


@_query
def log_topics(spark, sf_dir):
    return stored_topics(spark, _routed_log(spark, sf_dir))


@_query
def log_append(spark, sf_dir):
    """Offset ranges of a log written in two appends, read back from its files."""
    return offset_ranges(log_batch(spark, _routed_log(spark, sf_dir, segments=2)))


@_query
def validated_log_events(spark, sf_dir):
    """Validated topic written, read back and decoded."""
    log = log_batch(spark, _routed_log(spark, sf_dir), S.TOPIC_VALIDATED)
    return decode_envelope(log, "partition", "offset")


# Lake and backup


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated events under their raw-log offsets."""
    events = X.events_of(X.dense_log(spark, sf_dir))
    return events.withColumn("topic", F.lit(S.TOPIC_VALIDATED))


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark, "lake")
    write_lake(_validated(spark, sf_dir), root, BACKFILL_ROWS)
    return K.lake(spark, root)


@_query
def lake_daily_counts(spark, sf_dir):
    return _lake(spark, sf_dir).groupBy("dt", "p").agg(F.count(F.lit(1)).alias("rows"))


@_query
def lake_one_day(spark, sf_dir):
    return _lake(spark, sf_dir).where(F.col("dt") == F.lit(LAKE_DAY).cast("date"))


@_query
def lake_top_wikis(spark, sf_dir):
    return O.top_wikis(_lake(spark, sf_dir), 10)


def _backup(spark: SparkSession, sf_dir: str) -> str:
    root = workspace(spark, "backup")
    values = encode(*S.ENVELOPE_COLUMNS).cast("binary").alias("value")
    log = _validated(spark, sf_dir).select("topic", "partition", "offset", values)
    write_backup(log, root, BACKFILL_ROWS)
    return root


@_query
def backup_round_trip(spark, sf_dir):
    rows = K.backup(spark, _backup(spark, sf_dir))
    return rows.select(*S.ENVELOPE_COLUMNS, "p")


@_query
def backup_rewritten(spark, sf_dir):
    """The same objects put twice: lines per partition stay as they are."""
    root = workspace(spark, "backup")
    values = encode(*S.ENVELOPE_COLUMNS).cast("binary").alias("value")
    with kept(_validated(spark, sf_dir).select("topic", "partition", "offset", values)) as log:
        for _ in range(2):
            write_backup(log, root, BACKFILL_ROWS)
    return K.backup_lines(spark, root).groupBy("p").agg(F.count(F.lit(1)).alias("lines"))


@_query
def restore_round_trip(spark, sf_dir):
    """Backup lines put back on a log: same keys, partitions and order, offsets without gaps."""
    root = workspace(spark, "restored")
    restore(spark, _backup(spark, sf_dir), root)
    log = log_batch(spark, root, S.TOPIC_VALIDATED)
    return decode_envelope(
        log.withColumn("key", F.col("key").cast("string")), "key", "partition", "offset"
    )


# Streams


def _projected(spark: SparkSession, sf_dir: str) -> tuple[str, P.ReadModel]:
    """Read model fed in two rounds, so that redeliveries meet state of an earlier run."""
    root = workspace(spark, "log")
    model = P.ReadModel(workspace(spark, "model"))
    X.write_raw_topic(spark, sf_dir, root, segments=2)
    for number in (0, 1):
        raw = log_batch(spark, root, S.TOPIC_RAW, f"seed-{number}")
        C.routed_segment(raw, root, f"routed-{number}")
        P.project(spark, root, model)
    return root, model


@_query
def stream_page_activity(spark, sf_dir):
    _, model = _projected(spark, sf_dir)
    return P.current(spark, model, "page_activity")


@_query
def stream_wiki_stats(spark, sf_dir):
    _, model = _projected(spark, sf_dir)
    return R.wiki_stats_ranked(P.current(spark, model, "wiki_stats"))


@_query
def inspect_report(spark, sf_dir):
    """Report over the stored read model: its counts beside each of its top pages."""
    report = P.inspect(spark, _projected(spark, sf_dir)[1])
    return report["top"].join(report["counts"])  # one row of counts


@_query
def stream_ledger(spark, sf_dir):
    _, model = _projected(spark, sf_dir)
    return P.ledger(spark, model)


@_query
def stream_routed(spark, sf_dir):
    """Validator as a stream over the raw topic; offset ranges of what it wrote."""
    root = workspace(spark, "log")
    X.write_raw_topic(spark, sf_dir, root)
    drain(C.validator(spark, root, workspace(spark, "checkpoint")))
    return offset_ranges(log_batch(spark, root).where(F.col("topic") != S.TOPIC_RAW))


@_query
def stream_lake(spark, sf_dir):
    """Lake consumer as a stream over the validated topic."""
    root = _routed_log(spark, sf_dir)
    lake = workspace(spark, "lake")
    drain(C.laker(spark, root, lake, workspace(spark, "checkpoint"), rows=BACKFILL_ROWS))
    return K.lake(spark, lake)


@_query
def stream_backup(spark, sf_dir):
    """Backup consumer as a stream over the validated topic; its lines are the message values."""
    root = _routed_log(spark, sf_dir)
    backup = workspace(spark, "backup")
    drain(C.archiver(spark, root, backup, workspace(spark, "checkpoint"), rows=BACKFILL_ROWS))
    return K.backup_lines(spark, backup).select("value", "p")


@_query
def stream_ingest(spark, sf_dir):
    """Analytics ingest as a stream, then the rows-by-type panel over its table."""
    root = _routed_log(spark, sf_dir)
    table = workspace(spark, "events-table")
    event_time = utc_timestamp(F.col("occurred_at"))
    drain(
        C.ingest_events(
            spark, root, table, workspace(spark, "checkpoint"), ingested_at=event_time
        )
    )
    return O.events_by_type(events_table(spark, table))


@_query
def replay_is_noop(spark, sf_dir):
    """The whole validated topic delivered once more: nothing is applied, all of it skipped."""
    root, model = _projected(spark, sf_dir)
    C.routed_segment(log_batch(spark, root, S.TOPIC_RAW), root, "routed-again")
    again = P.project(spark, root, model)
    pages, ledger = P.current(spark, model, "page_activity"), P.ledger(spark, model)
    return R.counts(pages, ledger).select(
        "pages",
        "processed_events",
        F.lit(again["applied"]).cast("bigint").alias("applied_again"),
        F.lit(again["skipped"]).cast("bigint").alias("skipped_again"),
    )


@_query
def rebuild_equals(spark, sf_dir):
    """Read model rebuilt by replay, each page compared with the batch result over the log."""
    root, model = _projected(spark, sf_dir)
    P.rebuild(spark, root, model)
    rebuilt = P.current(spark, model, "page_activity")
    batch = P.rebuild_batch(spark, root)["page_activity"]
    sides = rebuilt.withColumn("replayed", F.lit(1)).unionByName(batch.withColumn("replayed", F.lit(0)))
    return sides.groupBy(R.PAGE_COLUMNS).agg(F.count(F.lit(1)).alias("sides"))


@_query
def run_counters(spark, sf_dir):
    """Counters of validator and projector, as their batches committed them."""
    root = workspace(spark, "log")
    model = P.ReadModel(workspace(spark, "model"))
    X.write_raw_topic(spark, sf_dir, root)
    drain(C.validator(spark, root, workspace(spark, "checkpoint")))
    counts = P.project(spark, root, model)
    value = lambda name: F.sum(F.when(F.col("name") == name, F.col("value"))).alias(name)
    return G.counters(spark, root, S.GROUP_VALIDATOR).agg(value("validated"), value("dead_lettered")).select(
        "validated",
        "dead_lettered",
        F.lit(counts["applied"]).cast("bigint").alias("applied"),
        F.lit(counts["skipped"]).cast("bigint").alias("skipped"),
    )


@_query
def backup_counters(spark, sf_dir):
    """Rows that the backup consumer handled in two runs, and whether it needed no more objects than
    rows, batches and partitions allow."""
    root, backup, checkpoint = (workspace(spark, name) for name in ("log", "backup", "checkpoint"))
    X.write_raw_topic(spark, sf_dir, root, segments=2)
    for number in (0, 1):
        C.routed_segment(log_batch(spark, root, S.TOPIC_RAW, f"seed-{number}"), root, f"routed-{number}")
        drain(C.archiver(spark, root, backup, checkpoint))
    value = lambda name: F.sum(F.when(F.col("name") == name, F.col("value")))
    most = value("rows") / S.BACKUP_MAX_ROWS + value("flushes") * S.TOPIC_PARTITIONS[S.TOPIC_VALIDATED]
    return G.counters(spark, root, S.GROUP_BACKUP).agg(
        value("rows").alias("rows"), (value("objects") <= most).alias("few_objects")
    )


@_query
def throughput_running(spark, sf_dir):
    """The running view after first deliveries, then redeliveries, whose minutes are all late."""
    root, panel, checkpoint = (workspace(spark, name) for name in ("log", "panel", "checkpoint"))
    X.write_raw_topic(spark, sf_dir, root, segments=2)
    event_time = utc_timestamp(F.col("occurred_at"))
    for number in (0, 1):
        C.routed_segment(log_batch(spark, root, S.TOPIC_RAW, f"seed-{number}"), root, f"routed-{number}")
        drain(start_throughput(spark, root, panel, checkpoint, ingested_at=event_time))
    return throughput_now(spark, panel)


@_query
def latest_events_stored(spark, sf_dir):
    """The same panel over the stored table, from the batches that its zone map names."""
    root, table = _routed_log(spark, sf_dir, segments=2), workspace(spark, "events-table")
    event_time = utc_timestamp(F.col("occurred_at"))
    drain(C.ingest_events(spark, root, table, workspace(spark, "checkpoint"), ingested_at=event_time, max_per_trigger=24))
    return latest_stored(spark, table).select("occurred_at", "wiki", "event_type")


@_query
def ingest_with_broken(spark, sf_dir):
    """Ten undecodable messages in the last block: set aside, and all other rows ingested."""
    root, table, checkpoint = _routed_log(spark, sf_dir), workspace(spark, "events-table"), workspace(spark, "checkpoint")
    rows = log_batch(spark, root, S.TOPIC_VALIDATED)
    broken = rows.orderBy("partition", "offset").limit(10).select("key", F.lit(b"{oops").alias("value"), "topic", "partition", "offset")
    drain(C.ingest_events(spark, root, table, checkpoint))
    append_log(broken.drop("partition").withColumnRenamed("offset", "n"), root, "broken", ["n", "key"])
    drain(C.ingest_events(spark, root, table, checkpoint))
    aside = spark.read.parquet(quarantine(table)).agg(F.count("value").alias("broken"))
    counted = events_table(spark, table).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.lit(0).alias("k"), "rows").join(aside.select(F.lit(0).alias("k"), "broken"), "k").drop("k")


@_query
def stored_page_lookup(spark, sf_dir):
    """One page of the stored read model, from its clustered snapshot and the batches since."""
    _, model = _projected(spark, sf_dir)
    P.compact(spark, model, "page_activity")
    return P.get_page(spark, model, "enwiki", "Page 0")


@_query
def state_audit(spark, sf_dir):
    """Ids of the projector's state held against its ledger."""
    _, model = _projected(spark, sf_dir)
    return P.state_audit(spark, model)


@_query
def ingest_time_default(spark, sf_dir):
    """Rows stamped without a given ingest time, and those stamped while the ingest ran."""
    root, table = _routed_log(spark, sf_dir), workspace(spark, "events-table")
    now = lambda: F.lit(spark.range(1).select(utc_now().cast("string")).first()[0]).cast("timestamp_ntz")
    start = now()
    drain(C.ingest_events(spark, root, table, workspace(spark, "checkpoint")))
    inside = F.col("ingested_at").between(start, now())
    return events_table(spark, table).agg(F.count(F.lit(1)).alias("rows"), F.count_if(inside).alias("in_time"))


@_query
def retry_after_failure(spark, sf_dir):
    """A backup whose handler fails after it wrote: nothing is committed; the next start writes the
    same batch again, and no line twice."""
    root, backup, checkpoint = _routed_log(spark, sf_dir), workspace(spark, "backup"), workspace(spark, "checkpoint")
    stream = log_stream(spark, root, S.TOPIC_VALIDATED, segments=True)

    def failing(batch, batch_id):
        write_backup(batch, backup)
        raise RuntimeError("lost before the commit")

    try:
        drain(consume(stream, failing, checkpoint, group="retried", log_root=root))
    except StreamingQueryException as error:
        if "lost before the commit" not in str(error):
            raise
    left = G.group_lag(spark, root, "retried", S.TOPIC_VALIDATED).agg(F.sum("lag").alias("left_by_failure"))
    failed = left.first()[0]
    drain(consume(stream, lambda batch, _: write_backup(batch, backup) and None, checkpoint, group="retried", log_root=root))
    now = G.group_lag(spark, root, "retried", S.TOPIC_VALIDATED).agg(F.sum("lag")).first()[0]
    return K.backup_lines(spark, backup).agg(
        F.count(F.lit(1)).alias("lines"),
        F.lit(failed).cast("bigint").alias("left_by_failure"),
        F.lit(now).cast("bigint").alias("left_at_end"),
    )


@_query
def bounded_flushes(spark, sf_dir):
    """Backup flushed by rows: lines of each partition, and whether every object keeps its limit (and a 64th)."""
    root, backup = _routed_log(spark, sf_dir), workspace(spark, "backup")
    drain(C.archiver(spark, root, backup, workspace(spark, "checkpoint"), rows=S.BACKUP_MAX_ROWS))
    sizes = K.backup_lines(spark, backup).groupBy("p", "rng").agg(F.count(F.lit(1)).alias("lines"))
    limit = S.BACKUP_MAX_ROWS + S.BACKUP_MAX_ROWS // 64
    return sizes.groupBy("p").agg(F.sum("lines").alias("lines"), (F.max("lines") <= limit).alias("within"))


@_query
def bounded_run(spark, sf_dir):
    """A running consumer stopped after some seconds, then drained: no row lost or handled twice; and
    whether progress was reported on the way."""
    root, backup, checkpoint = _routed_log(spark, sf_dir), workspace(spark, "backup"), workspace(spark, "checkpoint")
    reports = []
    listener = EveryN(100, lambda name, rows: reports.append(rows))
    spark.streams.addListener(listener)
    try:
        run_for(C.archiver(spark, root, backup, checkpoint, trigger=trigger_for(1), max_per_trigger=24), 5)
        drain(C.archiver(spark, root, backup, checkpoint))
        handled = G.counters(spark, root, S.GROUP_BACKUP).where("name = 'rows'").first().value
        lines = K.backup_lines(spark, backup).agg(F.count(F.lit(1)).alias("lines"))
        return lines.select("lines", F.lit(handled).cast("bigint").alias("handled"), F.lit(bool(reports)).alias("reported"))
    finally:
        spark.streams.removeListener(listener)


@_query
def poison_fails(spark, sf_dir):
    """One undecodable message on the validated topic: the read model stops, and keeps what it had."""
    root, model = _projected(spark, sf_dir)
    rows = log_batch(spark, root, S.TOPIC_VALIDATED).orderBy("partition", "offset").limit(1)
    append_log(rows.select("key", F.lit(b"{oops").alias("value"), "topic", F.lit(0).alias("n")), root, "poison", ["n"], cache=True)
    try:
        P.project(spark, root, model)
        stopped = False
    except StreamingQueryException as error:
        stopped = "malformed envelope" in str(error)
    pages, ledger = P.current(spark, model, "page_activity"), P.ledger(spark, model)
    return R.counts(pages, ledger).select("*", F.lit(stopped).alias("stopped"))


# Lag


@_query
def lag(spark, sf_dir):
    """Lag of a group that handled the first half of the arrivals, never saw partition 5 and has
    an empty commit on partition 4."""
    log = X.dense_log(spark, sf_dir).select("partition", "offset", "arrival")
    handled = log.where((F.col("arrival") < X.ARRIVALS // 2) & (F.col("partition") != 5))
    committed = handled.groupBy("partition").agg(
        F.when(F.col("partition") == 4, F.lit(-1).cast("bigint"))
        .otherwise(F.max("offset") + 1)
        .alias("committed")
    )
    partitions = G.partition_list(spark, S.TOPIC_RAW)
    return L.compute_lag(partitions, committed, L.high_water(log))


@_query
def total_lag(spark, sf_dir):
    return L.total_lag(lag(spark, sf_dir))


@_query
def group_lag_drained(spark, sf_dir):
    """Lag of the projector group after it handled the whole validated topic."""
    root, _ = _projected(spark, sf_dir)
    return G.group_lag(spark, root)


@_query
def lag_after_each_batch(spark, sf_dir):
    """Lag after the last batch of a rate-limited consumer, and the rows its batches counted against
    the lines it wrote."""
    root = _routed_log(spark, sf_dir, segments=2)
    backup, checkpoint = workspace(spark, "backup"), workspace(spark, "checkpoint")
    drain(C.archiver(spark, root, backup, checkpoint, rows=BACKFILL_ROWS, max_per_trigger=4))
    lags = G.lag_after_batches(spark, root, S.GROUP_BACKUP, S.TOPIC_VALIDATED)
    ends = lags.agg(F.min("total_lag").alias("last_lag"), F.sum("rows").alias("rows"))
    wrote = K.backup_lines(spark, backup).agg(F.count(F.lit(1)).alias("lines"))
    return ends.select(F.lit(0).alias("k"), "*").join(wrote.select(F.lit(0).alias("k"), "*"), "k").drop("k")


def _read_raw(spark, root: str, group: str, *segments: str) -> None:
    """A group that reads some segments of the raw topic, some files at a time, and keeps nothing."""
    stream = log_stream(spark, root, S.TOPIC_RAW, max_per_trigger=24, segments=True)
    stream = stream.where(F.col("segment").isin(*segments)) if segments else stream
    checkpoint = workspace(spark, "checkpoint")
    drain(consume(stream, lambda batch, batch_id: None, checkpoint, group=group, log_root=root))


@_query
def lag_on_gaps(spark, sf_dir):
    """Lag on a topic whose offsets have gaps, of a group that read all of it in batches of some files."""
    root = workspace(spark, "log")
    X.mirror_raw_topic(spark, sf_dir, root)
    _read_raw(spark, root, "all")
    rows = G.group_lag(spark, root, "all", S.TOPIC_RAW).withColumnRenamed("lag", "rows_left")
    offsets = G.offset_lag(spark, root, "all", S.TOPIC_RAW)
    return rows.join(offsets, ["partition", "committed", "high"])


@_query
def lag_out_of_order(spark, sf_dir):
    """Lag of a group that read the second of two appends first: nothing is committed, and what it
    has not handled is the first append."""
    root = workspace(spark, "log")
    X.mirror_raw_topic(spark, sf_dir, root)
    _read_raw(spark, root, "late", "seed-1")
    rows = G.group_lag(spark, root, "late", S.TOPIC_RAW).withColumnRenamed("lag", "rows_left")
    offsets = G.offset_lag(spark, root, "late", S.TOPIC_RAW)
    return rows.join(offsets, ["partition", "committed", "high"])


@_query
def null_key_routing(spark, sf_dir):
    """Raw rows that lost their key, routed: every one comes out on exactly one topic."""
    root = workspace(spark, "log")
    rows = X.raw_log(spark, sf_dir).withColumn("key", F.when(F.col("event_id") % 3 > 0, F.col("key")))
    C.routed_segment(rows, root, "routed-0")
    log = log_batch(spark, root)
    return log.groupBy("topic", F.col("key").isNull().alias("no_key")).agg(F.count(F.lit(1)).alias("rows"))


@_query
def restore_verbatim(spark, sf_dir):
    """Backup of raw payloads, many without a page key or not JSON at all, restored line by line."""
    backup, root = workspace(spark, "backup"), workspace(spark, "restored")
    write_backup(X.dense_log(spark, sf_dir), backup, BACKFILL_ROWS)
    restore(spark, backup, root)
    return log_batch(spark, root).select(
        "topic", F.col("key").cast("string").alias("key"), text(F.col("value")).alias("value")
    )


@_query
def limited_backup_order(spark, sf_dir):
    """A consumer of one file per batch, its backup restored: events of each page that are where they were."""
    root = _routed_log(spark, sf_dir, segments=2)
    backup, again = workspace(spark, "backup"), workspace(spark, "restored")
    drain(C.archiver(spark, root, backup, workspace(spark, "checkpoint"), max_per_trigger=1))
    restore(spark, backup, again)

    old, new = (
        decode_envelope(log_batch(spark, where, S.TOPIC_VALIDATED), "partition", "offset") for where in (root, again)
    )
    same = old.join(new, ["partition", "offset", "event_id"], "left_semi")
    return same.groupBy("wiki", "title").agg(F.count(F.lit(1)).alias("in_order"))


# Capture


def _capture(spark: SparkSession, sf_dir: str) -> str:
    """Capture files whose events have a heartbeat, an event name and an id around the data."""
    path = workspace(spark, "capture")
    lines = F.concat(
        F.lit(": heartbeat\nevent: message\nid: "),
        F.col("event_id").cast("string"),
        F.lit("\ndata: "),
        F.col("payload"),
    )
    events = X.deliveries(spark, sf_dir).select(lines.alias("value"))
    events.write.option("lineSep", "\n\n").text(path)
    return path


@_query
def sse_payloads(spark, sf_dir):
    return sse_capture(spark, _capture(spark, sf_dir))


@_query
def sse_server_payloads(spark, sf_dir):
    """The same capture read without a shuffle, as its events are one blank line apart."""
    return sse_capture(spark, _capture(spark, sf_dir), single_blank=True)


@_query
def sse_stream_payloads(spark, sf_dir):
    """The same capture read as a stream."""
    out = workspace(spark, "payloads")
    keep = lambda payloads, batch_id: payloads.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    drain(C.consume_captures(spark, _capture(spark, sf_dir), keep, workspace(spark, "checkpoint"), max_files=3))
    return spark.read.parquet(out).select("payload")


@_query
def stream_produced(spark, sf_dir):
    """Capture to raw topic as a stream."""
    root = workspace(spark, "log")
    drain(C.producer(spark, _capture(spark, sf_dir), root, workspace(spark, "checkpoint")))
    rows = log_batch(spark, root, S.TOPIC_RAW)
    return rows.select(
        F.col("key").cast("string").alias("key"), "partition", text(F.col("value")).alias("value")
    )


@_query
def produced_log(spark, sf_dir):
    """Capture to raw topic: key, partition and value of every keyable event."""
    root = workspace(spark, "log")
    C.produce(spark, _capture(spark, sf_dir), root, "capture-0", single_blank=True)
    rows = log_batch(spark, root, S.TOPIC_RAW)
    return rows.select(
        F.col("key").cast("string").alias("key"), "partition", text(F.col("value")).alias("value")
    )
