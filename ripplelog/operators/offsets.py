"""Offset ranges, and dense offsets assigned without gathering a partition in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ripplelog.functions.keys import range_label
from ripplelog.session import workspace

LOG_PARTITION = ["topic", "partition"]

# Rows of one offset chunk: the most one window group can hold.
CHUNK_ROWS = 100_000
# Rows of a task that writes ordered rows: a share of all of them for each core, within these bounds.
TASK_ROWS = (10_000, CHUNK_ROWS)


def offset_ranges(batch: DataFrame, *extra: str) -> DataFrame:
    """Lowest and highest offset, row count and range label per log partition (and ``extra``)."""
    ranges = batch.groupBy(*LOG_PARTITION, *extra).agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("rows")
    )
    return ranges.withColumn("label", range_label(F.col("lo"), F.col("hi")))


def chunk_of(position: Column, rows: int = CHUNK_ROWS) -> Column:
    """First position of the chunk that holds a position; exact on the whole long range."""
    return position - position % rows


def offset_runs(batch: DataFrame, width: int = CHUNK_ROWS, *extra: str) -> DataFrame:
    """Unbroken runs (lo, hi, rows) of a batch's offsets per log partition (and ``extra``).

    Runs end at multiples of ``width``, the column ``piece``, so that a window holds a bounded
    group. Only offsets are shuffled, to tasks of about :func:`task_rows`: they pack so well that Spark,
    which goes by bytes, would put millions of rows into one. The batch is counted for that, so keep it.
    """
    group = [*LOG_PARTITION, *extra]
    total = batch.count()
    tasks = total // task_rows(batch.sparkSession, total) + 1
    inside = Window.partitionBy(*group, "piece").orderBy("offset")
    jump = F.when(F.col("offset") > F.lag("offset").over(inside) + 1, 1).otherwise(0)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        batch.select(*group, "offset", chunk_of(F.col("offset"), width).alias("piece"))
        .repartition(tasks, *group, "piece")
        .withColumn("jump", jump)
        .withColumn("run", F.sum("jump").over(so_far))
        .groupBy(*group, "piece", "run")
        .agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("rows"))
        .drop("run")
    )


def task_rows(spark: SparkSession, total: int) -> int:
    """Rows a task should take of so many that are dealt in order; never more than the upper bound."""
    least, most = TASK_ROWS
    return min(max(total // spark.sparkContext.defaultParallelism, least), most)


def places_ahead(sizes: DataFrame, group: list[str], order: list[str], rows: str) -> DataFrame:
    """Counts of rows with ``_start``, the rows ahead in the same group, and ``_ahead``, those ahead in
    all groups. Groups are ordered apart; of all of them, only the totals are."""
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)  # a row per group
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    totals = sizes.groupBy(*group).agg(F.sum(rows).alias("_total"))
    firsts = totals.withColumn("_first", F.coalesce(F.sum("_total").over(before), none)).drop("_total")
    firsts = firsts.select("_first", *[F.col(name).alias(f"_of_{name}") for name in group])
    started = sizes.withColumn("_start", F.coalesce(F.sum(rows).over(within), none))
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in group]
    placed = started.join(firsts, same).withColumn("_ahead", F.col("_first") + F.col("_start"))
    return placed.drop("_first", *[f"_of_{name}" for name in group])


def dealt(rows: DataFrame, ahead: str, total: int) -> DataFrame:
    """Rows in tasks of about :func:`task_rows` of the ``total``, in the order of ``ahead``: the column
    ``_task`` has the number of each row's task. Rows of one ``ahead`` stay together."""
    size = task_rows(rows.sparkSession, total)
    placed = rows.withColumn("_task", F.floor(F.col(ahead) / size).cast("int"))
    return placed.repartitionById(total // size + 1, F.col("_task"))


def assign_offsets(
    df: DataFrame,
    order_by: list[str],
    chunk_by: list[str] | None = None,
    high_water: DataFrame | None = None,
) -> DataFrame:
    """Add a gap-free ``offset`` per (topic, partition), in the order of ``order_by``.

    One log partition may hold a third of all rows, so rows are numbered per chunk and shifted by
    the number of rows in earlier chunks. Each task takes some chunks that follow each other (see
    :func:`dealt`), so its rows are bounded and the files it writes are few. ``chunk_by`` names columns that sort like a prefix of
    ``order_by`` and hold a bounded number of rows each (an offset chunk, a file block). Without
    them, rows are counted, range-partitioned by order and staged in the shared folder, and each range
    is a chunk of about :func:`task_rows`; staging fixes the range bounds, which Spark samples anew for
    every plan.

    Chunk sizes are counted once and staged, since their totals and their order both start from them: two
    stages that make the rows of ``df`` at a time would each make most of them, also if it is kept. Starts
    are staged at once, too. No row is lost: group columns may be null, and a row that finds no start is an error.

    ``order_by`` must be unique per log partition. ``high_water`` (topic, partition, high) gives
    the first free offsets; a partition without a row starts at 0.
    """
    if chunk_by is None:
        chunk_by = ["_range"]
        spark = df.sparkSession
        total = df.count()
        ranged = df.repartitionByRange(
            total // task_rows(spark, total) + 1, *LOG_PARTITION, *order_by
        ).withColumn("_range", F.spark_partition_id())
        staged = workspace(spark, "ranged")
        ranged.write.parquet(staged)
        df = spark.read.schema(ranged.schema).parquet(staged)

    group = [*LOG_PARTITION, *chunk_by]
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    path = workspace(df.sparkSession, "sizes")
    counted.write.parquet(path)
    sizes = df.sparkSession.read.schema(counted.schema).parquet(path)
    starts, seen = places_ahead(sizes, LOG_PARTITION, chunk_by, "_rows"), Observation()
    if high_water is not None:
        starts = starts.join(high_water, LOG_PARTITION, "left").withColumn(
            "_start", F.col("_start") + F.coalesce(F.col("high"), F.lit(0).cast("bigint"))
        ).drop("high")
    starts = starts.observe(seen, F.sum("_rows").alias("rows")).select(
        "_start", "_ahead", *[F.col(name).alias(f"_of_{name}") for name in group]
    )
    path = workspace(df.sparkSession, "starts")
    starts.write.parquet(path)
    starts = df.sparkSession.read.schema(starts.schema).parquet(path)

    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in group]
    lost = F.raise_error(F.lit("a message has no offset")).cast("bigint")
    placed = df.join(starts, same, "left").drop(*[f"_of_{name}" for name in group])
    placed = placed.withColumn("_ahead", F.coalesce("_ahead", lost))
    chunk = Window.partitionBy("_task", *group).orderBy(*order_by)
    return (
        dealt(placed, "_ahead", seen.get["rows"] or 0)
        .withColumn("_row", F.row_number().over(chunk))
        .withColumn("offset", F.col("_start") + F.col("_row") - F.lit(1))
        .drop("_row", "_start", "_ahead", "_task", "_range")
    )
