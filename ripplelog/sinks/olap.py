"""Analytics table: Parquet sorted by event time and wiki, a folder per batch.

Beside it lies a zone map: the span of ingest times of each batch, written when the batch is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ripplelog.files import exists, remove, rename
from ripplelog.operators.olap import SORT_KEY, latest_events
from ripplelog.sinks.objects import kept
from ripplelog.sources.log import BROKEN, TooManyBrokenMessages

_ZONE = "lo timestamp_ntz, hi timestamp_ntz, rows bigint"


def _zones(table: str) -> str:
    return f"{table}_zones"


def quarantine(table: str) -> str:
    """Folder of the messages that ingest could not decode, a folder per batch."""
    return f"{table}_quarantine"


def _observed(rows: DataFrame, *more) -> tuple[DataFrame, Observation]:
    seen, good = Observation(), F.lit(True) if BROKEN not in rows.columns else ~F.col(BROKEN)
    time = F.when(good, F.col("ingested_at"))
    ends = [F.min(time).alias("lo"), F.max(time).alias("hi"), F.count_if(good).alias("rows")]
    return rows.observe(seen, *ends, *more), seen


def _publish_zone(spark: SparkSession, table: str, batch_id: int, seen: dict) -> None:
    zone = spark.createDataFrame([(seen["lo"], seen["hi"], seen["rows"])], _ZONE)
    zone.coalesce(1).write.mode("overwrite").parquet(f"{_zones(table)}/batch_id={batch_id}")


def write_events(rows: DataFrame, table: str, batch_id: int) -> None:
    """One micro-batch as its own folder, replaced when the batch is retried. Rows are sorted per
    file, which gives row groups narrow time ranges and long dictionary runs."""
    rows, seen = _observed(rows)
    rows.sortWithinPartitions(*SORT_KEY).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
    _publish_zone(rows.sparkSession, table, batch_id, seen.get)


def write_tolerant(rows: DataFrame, table: str, batch_id: int, max_broken: int) -> tuple[int, int]:
    """The same for rows with the columns ``value`` and :data:`BROKEN`; returns rows kept and broken.

    One pass decodes the batch, counts its broken messages and writes both kinds aside. Only if no
    more than ``max_broken`` are broken, the rows become part of the table and the broken messages
    of the quarantine; else TooManyBrokenMessages is raised and nothing is seen.
    """
    spark, aside = rows.sparkSession, f"{table}_aside/batch_id={batch_id}"
    rows, seen = _observed(rows, F.count_if(BROKEN).alias("broken"))
    value = F.when(F.col(BROKEN), F.col("value")).alias("value")
    names = [name for name in rows.columns if name not in ("value", BROKEN)]
    # The kind is a folder: empty of one kind means that there is no such folder.
    out = rows.select(*names, value, F.col(BROKEN).cast("int").alias("kind"))
    out.sortWithinPartitions("kind", *SORT_KEY).write.partitionBy("kind").mode("overwrite").parquet(aside)
    found = seen.get
    if found["broken"] > max_broken:
        remove(spark, aside)
        raise TooManyBrokenMessages(f"{found['broken']} broken messages in one block, {max_broken} allowed")
    for kind, home in ((1, quarantine(table)), (0, table)):
        target = f"{home}/batch_id={batch_id}"
        remove(spark, target)
        if exists(spark, f"{aside}/kind={kind}"):
            rename(spark, f"{aside}/kind={kind}", target)
    remove(spark, aside)
    _publish_zone(spark, table, batch_id, found)
    return found["rows"], found["broken"]


def write_events_ordered(rows: DataFrame, table: str, batch_id: int = 0) -> None:
    """A backfill in global order. ``event_id`` ends the sort key, so that one second of one wiki
    that holds many rows can still be split."""
    key = [*SORT_KEY, "event_id"]
    with kept(rows) as rows:  # Spark samples them first
        rows, seen = _observed(rows.repartitionByRange(*key))
        rows.sortWithinPartitions(*key).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
    _publish_zone(rows.sparkSession, table, batch_id, seen.get)


def events_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows of the table."""
    return spark.read.parquet(table).drop("batch_id", "value")


def newest_batches(spark: SparkSession, table: str, n: int) -> list[int]:
    """The batches that can hold some of the n rows ingested last, by the zone map alone.

    Take batches from the one that begins last on until they hold n rows; what begins and ends
    before the last of them begins can't be among the n.
    """
    zones = spark.read.schema(f"{_ZONE}, batch_id bigint").parquet(_zones(table)).where("rows > 0")
    later = Window.orderBy(F.desc("lo")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per batch
    enough = zones.withColumn("held", F.sum("rows").over(later)).where(F.col("held") >= n)
    bar = enough.agg(F.max("lo").cast("string")).first()[0]  # as text, which has no time zone
    needed = zones if bar is None else zones.where(F.col("hi") >= F.lit(bar).cast("timestamp_ntz"))
    return sorted(row.batch_id for row in needed.select("batch_id").collect())


def latest_stored(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    """:func:`latest_events` of the stored table, which opens only the batches that can matter."""
    folders = [f"{table}/batch_id={number}" for number in newest_batches(spark, table, n)]
    rows = spark.read.option("basePath", table).parquet(*folders) if folders else events_table(spark, table)
    return latest_events(rows, n)
