"""Committed offsets per consumer group, and lag reports over them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog import schema as S
from ripplelog.files import exists, remove
from ripplelog.operators.lag import compute_lag
from ripplelog.operators.offsets import CHUNK_ROWS, offset_runs
from ripplelog.sources.log import RANGES, segment_ranges

PROGRESS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("segment", T.StringType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
        T.StructField("total", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _folder(log_root: str, group: str) -> str:
    return f"{log_root}/progress/{group}"


def _few(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as one literal: Spark reads it itself, without a Python worker for each commit."""
    text = json.dumps([dict(zip(schema.fieldNames(), row, strict=True)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema))))


def commit_progress(
    batch: DataFrame, log_root: str, group: str, batch_id: int, counters: dict[str, int] | None = None
) -> None:
    """Publish the offsets of a handled batch as intervals (lo, hi, rows) per log partition.

    An interval says that all of its rows that the log holds were handled. A batch of a source that
    delivers in order, such as Kafka, is one interval per partition, whatever gaps its offsets have.
    The file log delivers files in any order: there (rows with a ``segment``), intervals are unbroken
    runs, unless the batch holds as many rows of a segment as were published. ``counters`` of the
    batch go with them.
    """
    spark, by_segment = batch.sparkSession, "segment" in batch.columns
    place = ["topic", "partition", *(["segment"] if by_segment else [])]
    ends = [F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("rows")]
    held = batch.groupBy(*place).agg(*ends).collect()  # a row for each partition of the batch's segments
    whole, rest = [(*row, None) for row in held], set()
    if by_segment:
        names = sorted({row.segment for row in held})
        ranges = segment_ranges(spark, log_root)
        known = [] if ranges is None else ranges.where(F.col("segment").isin(names)).select(*place, "rows").collect()
        published = {tuple(row[:3]): row[3] for row in known}
        full = lambda row: row.rows in (row.hi - row.lo + 1, published.get(tuple(row[:3])))
        whole = [(*row, None) for row in held if full(row)]
        rest = {row.segment for row in held if not full(row)}
    else:
        whole = [(row[0], row[1], None, *row[2:], None) for row in held]
    done = _few(
        spark,
        [*whole, (None, None, None, None, None, None, counters or {})],
        T.StructType([f for f in PROGRESS.fields if f.name not in ("total", "batch_id")]),
    )
    if rest:
        kept = {tuple(row[:3]) for row in whole}
        parts = batch.where(F.col("segment").isin(sorted(rest)))
        runs = offset_runs(parts, CHUNK_ROWS, "segment").drop("piece")
        done = done.unionByName(
            runs.join(_few(spark, sorted(kept), T.StructType([PROGRESS[name] for name in place])), place, "left_anti")
            if kept
            else runs,
            allowMissingColumns=True,
        )
    _publish(done.withColumn("total", F.lit(None).cast("bigint")), log_root, group, batch_id)


def counters(spark: SparkSession, log_root: str, group: str) -> DataFrame:
    """What the batches of a group counted (name, value), over all its runs: the rows they handled,
    their number (``flushes``), and counters of their handlers. Kept with the group's progress, so a
    restart or the loss of the driver forgets none."""
    commits = progress(spark, log_root, group)
    rows = commits.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("value"))
    flushes = commits.agg(F.countDistinct(F.when(F.col("rows") > 0, F.col("batch_id"))).alias("value"))
    own = commits.select(F.explode("counters").alias("name", "value")).groupBy("name").agg(F.sum("value").alias("value"))
    usual = [total.select(F.lit(name).alias("name"), "value") for name, total in (("rows", rows), ("flushes", flushes))]
    return usual[0].union(usual[1]).union(own)


def commit_totals(totals: DataFrame, log_root: str, group: str, batch_id: int) -> None:
    """Publish the rows (topic, partition, total) that a group has handled in all its batches."""
    none = {name: F.lit(None).cast(PROGRESS[name].dataType) for name in ("segment", "lo", "hi", "rows", "counters")}
    _publish(totals.coalesce(1).withColumns(none), log_root, group, batch_id)


def _publish(done: DataFrame, log_root: str, group: str, batch_id: int) -> None:
    columns = [name for name in PROGRESS.fieldNames() if name != "batch_id"]
    path = f"{_folder(log_root, group)}/batch_id={batch_id}"
    done.select(columns).write.mode("overwrite").parquet(path)


def forget_progress(spark: SparkSession, log_root: str, group: str) -> bool:
    """Drop what a group committed; it counts as never started."""
    return remove(spark, _folder(log_root, group))


def progress(spark: SparkSession, log_root: str, group: str) -> DataFrame:
    """All commits of a group, oldest batch first by ``batch_id``."""
    folder = _folder(log_root, group)
    if not exists(spark, folder):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).parquet(folder)


def partition_list(
    spark: SparkSession, topic: str, log_root: str | None = None
) -> DataFrame:
    """Partition numbers of a topic: the usual ones, and any other that the log holds."""
    numbers = spark.range(S.TOPIC_PARTITIONS.get(topic, 0)).select(
        F.col("id").cast("int").alias("partition")
    )
    ranges = segment_ranges(spark, log_root) if log_root else None
    if ranges is None:
        return numbers
    return numbers.union(ranges.where(F.col("topic") == topic).select("partition")).distinct()


def _commits(spark: SparkSession, log_root: str, group: str, topic: str, up_to_batch: int | None) -> DataFrame:
    commits = progress(spark, log_root, group).where(F.col("topic") == topic)
    return commits if up_to_batch is None else commits.where(F.col("batch_id") <= up_to_batch)


def _segments(spark: SparkSession, log_root: str, topic: str) -> DataFrame:
    ranges = segment_ranges(spark, log_root)
    ranges = spark.createDataFrame([], RANGES) if ranges is None else ranges
    return ranges.where(F.col("topic") == topic).select("partition", "segment", "lo", "hi", "rows")


def _handled(segments: DataFrame, commits: DataFrame) -> DataFrame:
    """Segments with the rows of each that were handled, ``done``. Of a group that publishes totals
    only, which reads in order, the first segments are those handled."""
    own = commits.where("segment IS NOT NULL").groupBy("partition", "segment").agg(F.sum("rows").alias("own"))
    totals = commits.where("segment IS NULL").groupBy("partition").agg(
        F.coalesce(F.max("total"), F.sum("rows")).alias("total")
    )
    earlier = Window.partitionBy("partition").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    left = F.coalesce("total", none) - F.coalesce(F.sum("rows").over(earlier), none)
    joined = segments.join(own, ["partition", "segment"], "left").join(totals, "partition", "left")
    done = F.coalesce("own", F.greatest(F.least(left, F.col("rows")), none), none)
    return joined.withColumn("done", done).drop("own", "total")


def committed_offsets(segments: DataFrame, commits: DataFrame) -> DataFrame:
    """Next offset (partition, committed) of the run of handled rows that starts at the first row
    the log holds; no row for a partition of which that one wasn't handled.

    Offsets that the log doesn't hold don't end a run. They are known to be missing between segments
    and in a segment all of whose rows were handled; in another one, a gap ends the run, so that
    the result may be too low meanwhile but never too high. Segments and intervals are few rows
    per append and batch.
    """
    ordered = Window.partitionBy("partition").orderBy("lo")
    whole = F.min(F.col("done") == F.col("rows")).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = _handled(segments, commits).withColumn("whole", whole)
    ends = marked.groupBy("partition").agg(
        F.max(F.when(F.col("whole"), F.col("hi") + 1)).alias("up_to"),
        F.min_by(F.struct("segment", "lo", "hi", "rows", "done"), F.when(~F.col("whole"), F.col("lo"))).alias("next"),
    )
    next_up = ends.select("partition", "next.*").withColumnsRenamed({"lo": "from", "hi": "to", "rows": "size"})
    runs = commits.where("segment IS NOT NULL").select("partition", "segment", "lo", "hi").distinct()
    inside = Window.partitionBy("partition").orderBy("lo")
    reached = F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("lo") > F.coalesce(reached + 1, F.col("from"))).cast("int")
    first = (
        runs.join(next_up.select("partition", "segment", "from"), ["partition", "segment"])
        .withColumn("apart", apart)
        .withColumn("apart", F.max("apart").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where("apart = 0")
        .groupBy("partition")
        .agg((F.max("hi") + 1).alias("within"))
    )
    # Of totals, the rest lies at the start of the next segment if that has no gaps.
    dense = (F.col("next.hi") - F.col("next.lo") + 1 == F.col("next.rows")) & (F.col("next.done") > 0)
    ahead = F.when(F.col("by_total") & dense, F.col("next.lo") + F.col("next.done"))
    by_total = commits.groupBy("partition").agg(F.every(F.col("segment").isNull()).alias("by_total"))
    joined = ends.join(first, "partition", "left").join(by_total, "partition", "left")
    committed = F.coalesce("within", ahead, "up_to")
    return joined.select("partition", committed.alias("committed")).where("committed IS NOT NULL")


def offset_lag(
    spark: SparkSession,
    log_root: str,
    group: str = S.GROUP_PROJECTOR,
    topic: str = S.TOPIC_VALIDATED,
    up_to_batch: int | None = None,
) -> DataFrame:
    """Lag of a group by offsets: from the next offset it has to read to the end of the log.

    All inputs are small tables that grow with the number of appends and batches, not with the
    log: the offset ranges of its segments and the intervals the group committed.
    """
    commits, segments = _commits(spark, log_root, group, topic, up_to_batch), _segments(spark, log_root, topic)
    high = segments.groupBy("partition").agg((F.max("hi") + 1).alias("high"))
    return compute_lag(partition_list(spark, topic, log_root), committed_offsets(segments, commits), high)


def group_lag(
    spark: SparkSession,
    log_root: str,
    group: str = S.GROUP_PROJECTOR,
    topic: str = S.TOPIC_VALIDATED,
    up_to_batch: int | None = None,
) -> DataFrame:
    """Lag of a group on a topic, now or as of one of its batches: the rows it has not handled.

    Offsets that the log doesn't hold are no lag, and neither are rows that a batch handled before
    lower ones; ``committed`` is the offset up to which everything was handled (:func:`offset_lag`).
    """
    commits, segments = _commits(spark, log_root, group, topic, up_to_batch), _segments(spark, log_root, topic)
    left = _handled(segments, commits).groupBy("partition").agg(F.sum(F.col("rows") - F.col("done")).alias("left"))
    lag = offset_lag(spark, log_root, group, topic, up_to_batch).drop("lag").join(left, "partition", "left")
    rest = F.coalesce("left", F.lit(0).cast("bigint"))
    return lag.select("partition", "committed", "high", rest.alias("lag")).orderBy("partition")


def kafka_lag(report: dict) -> list[tuple[str, int, int, int, int]]:
    """(topic, partition, committed, high, lag) of Kafka sources, from a progress report of Spark
    (``query.lastProgress``), which has the offsets of every partition before and after a batch."""
    rows = []
    for source in report["sources"]:
        if not str(source.get("description", "")).startswith("KafkaV2"):
            continue
        read = lambda name: json.loads(x) if isinstance(x := source.get(name), str) else x or {}  # noqa: B023, E731
        done, latest = read("endOffset"), read("latestOffset") or read("endOffset")
        for topic, ends in latest.items():
            for partition, high in ends.items():
                at = max(done.get(topic, {}).get(partition, 0), 0)
                rows.append((topic, int(partition), at, high, max(high - at, 0)))
    return sorted(rows)


def lag_after_batches(spark: SparkSession, log_root: str, group: str, topic: str) -> DataFrame:
    """Total lag after each batch of a group, against the present high-water marks.

    Needs a group that publishes the rows of each batch, as all but the projector do.
    """
    commits = progress(spark, log_root, group).where(F.col("topic") == topic)
    done = commits.where("rows IS NOT NULL").groupBy("batch_id").agg(F.sum("rows").alias("rows"))
    # One row per batch.
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = segment_ranges(spark, log_root).where(F.col("topic") == topic)
    high = ranges.agg(F.sum("rows")).first()[0] or 0
    left = F.lit(high) - F.sum("rows").over(so_far)
    return done.select("batch_id", "rows", left.cast("bigint").alias("total_lag"))
