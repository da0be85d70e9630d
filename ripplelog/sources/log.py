"""Topic scans: a keyed, partitioned, replayable log with Spark's Kafka schema.

Two backends give the same columns. ``kafka`` is Spark's connector (its jar must be on the class
path); ``files`` is a Parquet folder written by :mod:`ripplelog.sinks.log`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog import schema as S
from ripplelog.files import exists
from ripplelog.operators.decode import flagged_envelopes

_FILE_LOG = T.StructType([*S.LOG.fields, T.StructField("segment", T.StringType())])

RANGES = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("segment", T.StringType()),
    ]
)


def log_folder(root: str) -> str:
    return f"{root}/log"


def ranges_folder(root: str) -> str:
    return f"{root}/ranges"


def log_batch(
    spark: SparkSession, root: str, topic: str | None = None, segment: str | None = None
) -> DataFrame:
    """All rows of the file log, or of one topic or append (both are partition filters)."""
    rows = spark.read.schema(_FILE_LOG).parquet(log_folder(root))
    if topic is not None:
        rows = rows.where(F.col("topic") == topic)
    if segment is not None:
        rows = rows.where(F.col("segment") == segment)
    return rows.select(S.LOG_COLUMNS)


def log_stream(
    spark: SparkSession,
    root: str,
    topic: str,
    max_per_trigger: int | None = None,
    segments: bool = False,
) -> DataFrame:
    """One topic of the file log as a stream from its first file on.

    Progress lives in the checkpoint of the query that uses it, so any number of consumers read
    the log independently. ``max_per_trigger`` bounds the files of a micro-batch. ``segments`` adds
    the column ``segment``, from which progress knows what a batch left out.
    """
    inside = T.StructType([field for field in _FILE_LOG if field.name != "topic"])
    reader = spark.readStream.schema(inside)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    rows = reader.parquet(f"{log_folder(root)}/topic={topic}")
    return rows.withColumn("topic", F.lit(topic)).select(*S.LOG_COLUMNS, *(["segment"] if segments else []))


def kafka_options(
    servers: str,
    topic: str,
    max_rows: int | None = None,
    seconds: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source: earliest on first start; a batch starts at ``max_rows`` new
    rows or after ``seconds``, and takes at most ``max_per_trigger`` rows."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_rows is not None:
        options["minOffsetsPerTrigger"] = str(max_rows)
    if seconds is not None:
        options["maxTriggerDelay"] = f"{seconds}s"
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **limits: int) -> DataFrame:
    """One Kafka topic as a stream."""
    options = kafka_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load().select(S.LOG_COLUMNS)


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a Kafka topic holds now."""
    options = kafka_options(servers, topic)
    return spark.read.format("kafka").options(**options).load().select(S.LOG_COLUMNS)


def segment_ranges(spark: SparkSession, root: str) -> DataFrame | None:
    """Offset ranges of all appends, a few rows per append; None before the first one."""
    if not exists(spark, ranges_folder(root)):
        return None
    return spark.read.schema(RANGES).parquet(ranges_folder(root))


def topics(log: DataFrame) -> DataFrame:
    """Sorted unique topic names."""
    return log.select("topic").distinct().orderBy("topic")


def stored_topics(spark: SparkSession, root: str) -> DataFrame:
    """The same for a file log, from the offset ranges of its appends and not from its rows."""
    ranges = segment_ranges(spark, root)
    return topics(spark.createDataFrame([], RANGES) if ranges is None else ranges)


#: Whether a message could not be decoded.
BROKEN = "_broken"


def flagged_rows(log: DataFrame, row_schema: T.StructType, *keep: str) -> DataFrame:
    """JSON-per-row values as columns (absent fields get their zero value) and ``_broken``, decoded
    as strictly as events are."""
    return flagged_envelopes(log, row_schema, *keep)


class TooManyBrokenMessages(RuntimeError):
    """A block held more undecodable messages than it may skip."""


@contextmanager
def log_rows(
    block: DataFrame, row_schema: T.StructType, *keep: str, max_broken: int = 10
) -> Iterator[DataFrame]:
    """Rows of one block (a micro-batch) without its broken messages; more than ``max_broken`` of
    them fail the block before anything is written. The block is decoded once and cached while
    the ``with`` body runs, since it is first counted and then used."""
    flagged = flagged_rows(block, row_schema, *keep).persist()
    try:
        broken = flagged.where(BROKEN).count()
        if broken > max_broken:
            raise TooManyBrokenMessages(
                f"{broken} broken messages in one block, {max_broken} allowed"
            )
        yield flagged.where(~F.col(BROKEN)).drop(BROKEN)
    finally:
        flagged.unpersist()
