"""The independent consumers of the log, each with its own checkpoint.

They read the file log under ``log_root`` unless ``source`` gives another stream with the log's
columns, such as :func:`ripplelog.sources.log.kafka_stream`. ``log_root`` also holds their progress.

Poison policy: the producer skips what it cannot key, the validator dead-letters, the analytics
table tolerates a few broken messages per block, read model and lake fail.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplelog import schema as S
from ripplelog.operators.decode import decode_envelope
from ripplelog.operators.offsets import chunk_of
from ripplelog.operators.olap import olap_rows
from ripplelog.operators.routing import produced, route
from ripplelog.sinks.log import append_log
from ripplelog.sinks.objects import write_backup, write_lake
from ripplelog.sinks.olap import write_tolerant
from ripplelog.sources.log import BROKEN, flagged_rows, log_stream, segment_ranges
from ripplelog.sources.sse import BLOCK, POSITION, capture_files, sse_capture
from ripplelog.streaming.runner import consume

POSITION_COLUMNS = ["topic", "partition", "offset"]


def produce(spark: SparkSession, capture: str, log_root: str, segment: str, **how: bool) -> None:
    """Append the keyable events of a capture to the raw topic in capture order; ``how`` are
    options of :func:`sse_capture`."""
    payloads = sse_capture(spark, capture, position=True, **how)
    messages = produced(payloads, "payload", *POSITION)
    append_log(messages, log_root, segment, POSITION, BLOCK, cache=True)


def consume_captures(
    spark: SparkSession,
    capture: str,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Call ``handler(payloads, batch_id)`` with the events of capture files as the files appear.

    The stream is one of file names; the payloads of a micro-batch's files are read as any capture,
    split between tasks, so files may have any size.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # names of one micro-batch
        if paths:
            handler(sse_capture(spark, paths, position=True), batch_id)

    return consume(capture_files(spark, capture, max_files), handle, checkpoint, trigger)


def producer(
    spark: SparkSession,
    capture: str,
    log_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append the keyable events of capture files to the raw topic as the files appear."""

    def handle(payloads: DataFrame, batch_id: int) -> None:
        messages = produced(payloads, "payload", *POSITION)
        append_log(messages, log_root, f"producer-{batch_id:012d}", POSITION, BLOCK, cache=True)

    return consume_captures(spark, capture, handle, checkpoint, trigger, max_files)


def routed_segment(raw: DataFrame, log_root: str, segment: str) -> None:
    """Append the routed messages of some raw log rows as one segment.

    They are numbered per stretch of source offsets. Offsets with gaps say little about the rows of a
    stretch, down to one row in each; such messages are numbered by ranges of their order instead.
    """
    order = ["source_partition", "source_offset"]
    spans = raw.groupBy("topic", "partition").agg(
        (F.max("offset") - F.min("offset")).cast("double").alias("span"), F.count(F.lit(1)).alias("rows")
    )
    gaps = spans.agg(F.sum("span") > 2 * F.sum("rows")).first()[0]
    routed, chunks = route(raw), None
    if not gaps:
        routed = routed.withColumn("source_chunk", chunk_of(F.col("source_offset")))
        chunks = ["source_partition", "source_chunk"]
    append_log(routed, log_root, segment, order, chunks, cache=True)


def validator(
    spark: SparkSession,
    log_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
    append: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Route the raw topic to the validated and the dead-letter topic of the file log, or to
    ``append`` (such as ``lambda rows: append_kafka(rows, servers)``)."""

    def handle(batch: DataFrame, batch_id: int) -> dict[str, int]:
        if append is not None:
            append(route(batch))
            return {}
        segment = f"{S.GROUP_VALIDATOR}-{batch_id:012d}"
        routed_segment(batch, log_root, segment)
        ranges = segment_ranges(spark, log_root)
        sums = [] if ranges is None else ranges.where(F.col("segment") == segment).groupBy("topic").agg(F.sum("rows")).collect()
        names = {S.TOPIC_VALIDATED: "validated", S.TOPIC_DEAD_LETTER: "dead_lettered"}
        return {names[topic]: rows for topic, rows in sums}

    if source is None:
        source = log_stream(spark, log_root, S.TOPIC_RAW, max_per_trigger, segments=True)
    return consume(source, handle, checkpoint, trigger, S.GROUP_VALIDATOR, log_root)


def archiver(
    spark: SparkSession,
    log_root: str,
    backup_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    rows: int = S.BACKUP_MAX_ROWS,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
) -> StreamingQuery:
    """Back up the validated topic verbatim."""

    def handle(batch: DataFrame, batch_id: int) -> dict[str, int]:
        return {"objects": write_backup(batch, backup_root, rows)}

    if source is None:
        source = log_stream(spark, log_root, S.TOPIC_VALIDATED, max_per_trigger, segments=True)
    return consume(source, handle, checkpoint, trigger, S.GROUP_BACKUP, log_root)


def laker(
    spark: SparkSession,
    log_root: str,
    lake_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    rows: int = S.LAKE_MAX_ROWS,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
) -> StreamingQuery:
    """Write the validated topic to the Parquet lake."""

    def handle(batch: DataFrame, batch_id: int) -> dict[str, int]:
        return {"objects": write_lake(decode_envelope(batch, *POSITION_COLUMNS), lake_root, rows)}

    if source is None:
        source = log_stream(spark, log_root, S.TOPIC_VALIDATED, max_per_trigger, segments=True)
    return consume(source, handle, checkpoint, trigger, S.GROUP_LAKE, log_root)


def ingest_events(
    spark: SparkSession,
    log_root: str,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_broken: int = 10,
    ingested_at: Column | None = None,
    topic: str = S.TOPIC_VALIDATED,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
) -> StreamingQuery:
    """Append every validated row to the analytics table, with ingest time. Up to ``max_broken``
    undecodable messages of a batch are set aside; more of them fail it, and nothing of it is seen."""

    def handle(batch: DataFrame, batch_id: int) -> dict[str, int]:
        flagged = flagged_rows(batch, S.ENVELOPE, "partition", "offset", "value")
        rows = olap_rows(flagged, "partition", "offset", "value", BROKEN, ingested_at=ingested_at)
        kept, broken = write_tolerant(rows, table, batch_id, max_broken)
        return {"kept": kept, "broken": broken}

    if source is None:
        source = log_stream(spark, log_root, topic, max_per_trigger, segments=True)
    return consume(source, handle, checkpoint, trigger, S.GROUP_OLAP, log_root)
