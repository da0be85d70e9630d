"""Backup and lake: one folder per object of a log partition, replaced when written again.

Tasks take rows in order and in bounded numbers, so a large object has several files, whose names sort
as their rows do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.files import remove
from ripplelog.functions.keys import range_label
from ripplelog.functions.times import utc_date
from ripplelog.operators.decode import text, with_page_key
from ripplelog.operators.offsets import chunk_of, dealt, offset_runs, places_ahead
from ripplelog.session import workspace
from ripplelog.sinks.log import append_log
from ripplelog.sources.lake import backup_folder, lake_folder, ordered_lines, runs_folder


#: Pieces of an offset range that are counted to pack objects: the share by which one may be larger.
_PIECES = 64


def pack(batch: DataFrame, rows: int, *extra: str) -> DataFrame:
    """Offset runs of a batch, each with the object it goes to.

    Per log partition (and ``extra``), objects take ``rows`` rows in offset order, at most a 64th
    more, so there are no more of them than rows / ``rows`` and one for the rest, whatever offsets
    the batch leaves out. ``_ahead`` is the number of rows in pieces ahead of a run's. ``first`` is where the first unbroken run of the object ends, ``last``
    where the object does. Only offsets are shuffled, in bounded groups; what is ordered per log
    partition or object is one row per piece of its offset range. Runs are staged, as they are read twice.
    """
    spark, path = batch.sparkSession, workspace(batch.sparkSession, "offset-runs")
    group = ["topic", "partition", *extra]
    runs = offset_runs(batch, max(1, rows // _PIECES), *extra)
    runs.write.parquet(path)
    runs = spark.read.schema(runs.schema).parquet(path)
    sizes = runs.groupBy(*group, "piece").agg(
        F.sum("rows").alias("size"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.min_by("hi", "lo").alias("end"),
    )
    sizes = places_ahead(sizes, group, ["piece"], "size").withColumn("object", F.floor(F.col("_start") / rows))
    whole = Window.partitionBy(*group, "object")
    in_order = whole.orderBy("piece")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A piece goes on with the first run if it begins where the one before ends, and that is all one run.
    before = F.lag(F.struct("hi", "end")).over(in_order)
    joint = (F.col("lo") > before["hi"] + 1) | (before["end"] < before["hi"])
    homes = (
        sizes.withColumn("run", F.sum(F.when(joint, 1).otherwise(0)).over(so_far))
        .withColumns(
            {
                "start": F.min("lo").over(whole),
                "first": F.max(F.when(F.col("run") == 0, F.col("end"))).over(whole),
                "last": F.max("hi").over(whole),
            }
        )
        .select(*group, "piece", "_ahead", "start", "first", "last")
    )
    return runs.join(homes, [*group, "piece"])


def pack_pieces(batch: DataFrame, rows: int, *extra: str) -> DataFrame:
    """Pieces of a batch's offset range, each with the object it goes to, packed as by :func:`pack`; for
    objects that are named by all they span, ``start`` to ``last``. That takes no runs, of which there may be as
    many as rows (offsets of one day): pieces are counted where the rows are, and nothing of a row is shuffled.
    """
    group = ["topic", "partition", *extra]
    pieces = batch.select(*group, "offset", chunk_of(F.col("offset"), max(1, rows // _PIECES)).alias("piece"))
    sizes = pieces.groupBy(*group, "piece").agg(
        F.count(F.lit(1)).alias("rows"), F.min("offset").alias("lo"), F.max("offset").alias("hi")
    )
    placed = places_ahead(sizes, group, ["piece"], "rows").withColumn("object", F.floor(F.col("_start") / rows))
    whole = Window.partitionBy(*group, "object")
    return placed.withColumns({"start": F.min("lo").over(whole), "last": F.max("hi").over(whole)})


def with_range(batch: DataFrame, runs: DataFrame, rows: int, *extra: str) -> DataFrame:
    """Add the name ``rng`` of the object each row goes to, and ``_ahead``, from staged rows of :func:`pack`
    or :func:`pack_pieces` that have them. These are far fewer than rows; Spark broadcasts them if their files are small."""
    group = ["topic", "partition", *extra, "piece"]
    names = runs.select(*group, "rng", "_ahead").distinct()
    lost = F.raise_error(F.lit("a row has no object")).cast("string")
    placed = batch.withColumn("piece", chunk_of(F.col("offset"), max(1, rows // _PIECES)))
    named = placed.join(names, group, "left").withColumn("rng", F.coalesce("rng", lost))
    return named.drop("piece").withColumnRenamed("partition", "p")


def _stage(runs: DataFrame, path: str, *drop: str) -> tuple[DataFrame, int, int]:
    """Packed runs or pieces written and read again, how many objects there are, and how many rows."""
    seen = Observation()
    counts = (F.count_if(F.col("lo") == F.col("start")).alias("objects"), F.sum("rows").alias("total"))
    out = runs.observe(seen, *counts).drop("start", "first", "last", *drop)
    out.write.parquet(path)
    return out.sparkSession.read.schema(out.schema).parquet(path), seen.get["objects"], seen.get["total"] or 0


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that are read more than once, kept in between unless they are already; a lost executor
    only means that its share is made again."""
    if rows.is_cached:
        yield rows
        return
    rows = rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def write_backup(batch: DataFrame, root: str, rows: int = S.BACKUP_MAX_ROWS) -> int:
    """Message values verbatim as gzip text lines in offset order; returns the number of objects.

    An object may hold several offset runs. It is named by the first of them: no two runs share an
    offset, so neither names nor, for batches that hold other offsets in between, their order get
    mixed up. All runs stand in a manifest beside the objects, from which :func:`ordered_lines`
    finds the place of every line. A batch that is written again replaces its objects and repeats
    their manifest rows.
    """
    messages = batch if batch.is_cached else batch.select("topic", "partition", "offset", "value")
    with kept(messages) as messages:
        return _write_backup(messages.select("topic", "partition", "offset", "value"), root, rows)


def _write_backup(messages: DataFrame, root: str, rows: int) -> int:
    folders = ["topic", "p", "rng"]
    runs = pack(messages, rows).withColumn("rng", range_label(F.col("start"), F.col("first")))
    manifest = f"{runs_folder(root)}/write={uuid.uuid4().hex}"
    staged, objects, total = _stage(runs, manifest)
    (
        dealt(with_range(messages, staged, rows), "_ahead", total)
        .sortWithinPartitions(*folders, "offset")
        .select(text(F.col("value")).alias("value"), *folders)
        .write.partitionBy(*folders)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .text(backup_folder(root))
    )
    return objects


def write_lake(events: DataFrame, root: str, rows: int = S.LAKE_MAX_ROWS) -> int:
    """Envelopes as Parquet, one UTC day per object, rows in offset order; returns the number of
    objects.

    ``events`` has the envelope columns and ``topic``, ``partition``, ``offset``.
    """
    columns = ["topic", "partition", "offset", *S.ENVELOPE_COLUMNS]
    with kept(events.select(*columns, utc_date(F.col("occurred_at")).alias("dt"))) as dated:
        return _write_lake(dated, root, rows)


def _write_lake(dated: DataFrame, root: str, rows: int) -> int:
    folders = ["dt", "p", "rng"]
    pieces = pack_pieces(dated, rows, "dt").withColumn("rng", range_label(F.col("start"), F.col("last")))
    path = workspace(dated.sparkSession, "pieces")
    staged, objects, total = _stage(pieces, path, "lo", "hi", "rows", "object", "_start")
    (
        dealt(with_range(dated, staged, rows, "dt"), "_ahead", total)
        .sortWithinPartitions(*folders, "offset")
        .select(*S.ENVELOPE_COLUMNS, *folders)
        .write.partitionBy(*folders)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .parquet(lake_folder(root))
    )
    remove(dated.sparkSession, path)
    return objects


def restore(spark, backup_root: str, log_root: str, segment: str = "restore") -> None:
    """Put all backup lines back on a log, values untouched and in their old order.

    The backup holds values only, so the key is computed from ``wiki`` and ``title`` again; a line
    that yields none is restored without a key. Lines are numbered by files and bounded stretches of
    offsets (see :func:`ordered_lines`), without gathering a partition.
    """
    messages = with_page_key(ordered_lines(spark, backup_root)).select(
        F.col("page_key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        "at",
        "p",
        "file",
        "seq",
    )
    append_log(messages, log_root, segment, ["at", "p", "file", "seq"], ["at", "p", "file"])
