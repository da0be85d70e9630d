"""Dashboard panels that are kept up to date while events arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ripplelog import schema as S
from ripplelog.functions.times import unix_seconds, utc_timestamp
from ripplelog.operators.olap import olap_rows
from ripplelog.session import configure
from ripplelog.sources.log import BROKEN, flagged_rows, log_stream
from ripplelog.streaming.runner import DRAIN

_PANEL = "time timestamp_ntz, events bigint, batch_id bigint"


def start_throughput(
    spark: SparkSession,
    log_root: str,
    panel: str,
    checkpoint: str,
    trigger: dict | None = None,
    ingested_at: Column | None = None,
    late: str | None = None,
    max_per_trigger: int | None = None,
    source: DataFrame | None = None,
) -> StreamingQuery:
    """Rows of the validated topic per ingest minute, as a running view under ``panel``.

    The counts are state of the query; each micro-batch upserts the minutes it touched, and a retried
    one replaces what it wrote, so redelivered batches don't count twice. Messages that don't
    decode aren't counted. Without ``late`` every row counts however late it is, and state keeps all
    minutes; with it (such as "1 hour"), minutes older than that leave the state, and rows for them
    no longer count. With the default ingest time, now, no row is ever late.
    """
    configure(spark)
    if source is None:
        source = log_stream(spark, log_root, S.TOPIC_VALIDATED, max_per_trigger)
    rows = olap_rows(flagged_rows(source, S.ENVELOPE).where(~F.col(BROKEN)), ingested_at=ingested_at)
    timed = rows.select(F.timestamp_seconds(unix_seconds(F.col("ingested_at"))).alias("at"))  # watermarks want instants
    timed = timed.withWatermark("at", late) if late else timed
    counted = timed.groupBy(F.window("at", "1 minute").alias("minute")).agg(F.count(F.lit(1)).alias("events"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(utc_timestamp(F.unix_timestamp("minute.start")).alias("time"), "events")
        changed.repartition(1).write.mode("overwrite").parquet(f"{panel}/batch_id={batch_id}")

    writer = counted.writeStream.outputMode("update").foreachBatch(upsert)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start()


def throughput_now(spark: SparkSession, panel: str) -> DataFrame:
    """The panel: the newest count of each minute, in time order."""
    rows = spark.read.schema(_PANEL).parquet(panel)
    newest = rows.groupBy("time").agg(F.max_by("events", "batch_id").alias("events"))
    return newest.orderBy("time")
