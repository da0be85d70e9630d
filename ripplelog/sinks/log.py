"""Append to the log: same key, same partition; value bytes untouched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions.keys import partition_for
from ripplelog.operators.offsets import LOG_PARTITION, assign_offsets
from ripplelog.sources.log import RANGES, log_folder, ranges_folder, segment_ranges


def _partition_count(partitions: dict[str, int] | None) -> Column:
    unknown = F.raise_error(
        F.concat(F.lit("no partition count is known for topic "), F.coalesce("topic", F.lit("null")))
    )
    count = unknown.cast("int")
    for topic, number in {**S.TOPIC_PARTITIONS, **(partitions or {})}.items():
        count = F.when(F.col("topic") == topic, F.lit(number)).otherwise(count)
    return count


def with_partition(messages: DataFrame, partitions: dict[str, int] | None = None) -> DataFrame:
    """Add the partition of each message: by key hash, over the partition count of its topic.

    A message without a key goes by its value instead, so it has one place, too, and messages
    without keys are spread. ``partitions`` names further topics or other counts; a topic without
    a count is an error.
    """
    home = F.coalesce("key", "value", F.lit(b"")).cast("string")
    return messages.withColumn("partition", partition_for(home, _partition_count(partitions)))


def append_log(
    messages: DataFrame,
    root: str,
    segment: str,
    order_by: list[str],
    chunk_by: list[str] | None = None,
    cache: bool = False,
    partitions: dict[str, int] | None = None,
) -> None:
    """Append ``key``, ``value``, ``topic`` rows to the file log as one named segment.

    Every row is stored, also without a key; see :func:`with_partition` for ``partitions``.
    Offsets continue where other segments end and follow ``order_by`` (see
    :func:`assign_offsets`). A segment is published by its offset ranges, which are written last.
    Appending a published segment again does nothing, so a retried micro-batch does not duplicate
    and readers keep the files they hold; what a crash left of an unpublished one is replaced.
    One writer per topic at a time.

    Numbering reads the messages twice. ``cache`` keeps them in between, for messages that are
    costly to make; a lost executor only means that its share is made again.
    """
    if cache:
        messages = messages.persist()
        try:
            append_log(messages, root, segment, order_by, chunk_by, partitions=partitions)
        finally:
            messages.unpersist()
        return
    spark = messages.sparkSession
    taken = segment_ranges(spark, root)
    if taken is not None:
        if not taken.where(F.col("segment") == segment).isEmpty():
            return
        taken = taken.groupBy(*LOG_PARTITION).agg((F.max("hi") + 1).alias("high"))
    if "timestamp" not in messages.columns:
        messages = messages.withColumn("timestamp", F.current_timestamp())
    _publish(assign_offsets(with_partition(messages, partitions), order_by, chunk_by, taken), root, segment)


def mirror_log(rows: DataFrame, root: str, segment: str) -> None:
    """Store log rows as one named segment under the partitions and offsets they have, gaps and all,
    as for a copy of a compacted topic. Offsets must lie beyond those of earlier segments; mirroring
    a published segment again does nothing."""
    if "timestamp" not in rows.columns:
        rows = rows.withColumn("timestamp", F.current_timestamp())
    taken = segment_ranges(rows.sparkSession, root)
    if taken is None or taken.where(F.col("segment") == segment).isEmpty():
        _publish(rows, root, segment)


def _publish(numbered: DataFrame, root: str, segment: str) -> None:
    """Write the rows of a segment, then its offset ranges, which make it count."""
    spark = numbered.sparkSession
    (
        numbered.withColumn("segment", F.lit(segment))
        .sortWithinPartitions(*LOG_PARTITION, "segment", "offset")
        .select(*S.LOG_COLUMNS, "segment")
        .write.partitionBy(*LOG_PARTITION, "segment")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(log_folder(root))
    )
    written = f"{log_folder(root)}/topic=*/partition=*/segment={segment}"
    try:
        rows = spark.read.schema(S.T.StructType([*S.LOG.fields, RANGES["segment"]])).option(
            "basePath", log_folder(root)
        ).parquet(written)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):  # no message at all, so no folder
            return
        raise
    (
        rows.groupBy(*LOG_PARTITION)
        .agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("rows"))
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{ranges_folder(root)}/segment={segment}")
    )


def append_kafka(
    messages: DataFrame, servers: str, partitions: dict[str, int] | None = None
) -> None:
    """Append to Kafka, with the same key-to-partition rule."""
    (
        with_partition(messages, partitions)
        .select("key", "value", "topic", "partition")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
