"""Scan of captured server-sent events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Lines of one event that carry data, without the field name and one leading space. (?d) makes \n
# the only line end, so that other separators inside a payload stay untouched.
_DATA_LINE = r"(?md)^data: ?(.*)$"

# Position columns of a captured event: they sort like the capture, and a file block is bounded.
BLOCK = ["file", "block"]
POSITION = [*BLOCK, "seq"]


def _where() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]


def _joined(lines: Column) -> Column:
    """Data lines joined by newline; empty leading data lines add nothing, as joining only starts
    once there is text."""
    return F.ltrim(F.array_join(lines, "\n"), F.lit("\n"))


def sse_capture(
    spark: SparkSession,
    path: str | list[str],
    single_blank: bool = False,
    crlf: bool = False,
    position: bool = False,
) -> DataFrame:
    """Payload of every event in capture files, as column ``payload``.

    An event ends at a blank line or the end of its file. Comments, other fields and events
    without data give no row. Line ends may be ``\\n`` or ``\\r\\n`` in any mix. ``position`` adds
    the columns of :data:`POSITION`.

    Files are split between tasks. By default the lines of a file block are put together in one
    task and events cut by a block end are joined afterwards, which is right for any capture and
    shuffles it once. ``single_blank`` says that events are separated by exactly one blank line
    (``crlf``: that ends in ``\\r\\n``), as servers write them: the blank line is then the record
    separator of the text source and nothing is shuffled. Runs of blank lines are also read right
    that way unless a file is split inside of one.
    """
    if single_blank:
        return _by_separator(spark, path, crlf, position)
    return _by_lines(spark, path, position)


def _events(text: Column) -> Column:
    """Texts between blank lines, whose own ends may be of either kind."""
    return F.split(F.regexp_replace(text, r"\r(\n|\z)", "$1"), "\n\n")


# Columns of Spark's source of whole files. Only the path is read here, never the content.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def capture_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of the names of capture files (column ``path``) as they appear; ``max_files`` bounds a
    micro-batch. The files themselves are for :func:`sse_capture`, which splits them between tasks."""
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path")


def _by_separator(spark: SparkSession, path: str, crlf: bool, position: bool) -> DataFrame:
    chunks = spark.read.option("lineSep", "\r\n\r\n" if crlf else "\n\n").text(path)
    where = _where() if position else []
    events = chunks.select(*where, F.explode(_events(F.col("value"))).alias("_event"))
    if position:
        events = events.withColumn("seq", F.monotonically_increasing_id())
    return _payloads(events, position)


def _payloads(events: DataFrame, position: bool) -> DataFrame:
    lines = F.regexp_extract_all(F.col("_event"), F.lit(_DATA_LINE), F.lit(1))
    payloads = events.withColumn("payload", _joined(lines)).where(F.col("payload") != "")
    return payloads.select("payload", *(POSITION if position else []))


def _by_lines(spark: SparkSession, path: str, position: bool) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        *_where(),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", r"\r\z", "").alias("line"),
    )
    blank = F.col("line") == ""
    kept = lines.where(blank | F.col("line").startswith("data:"))
    block = Window.partitionBy(*BLOCK)
    so_far = block.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.when(blank, 1).otherwise(0)
    numbered = kept.select(
        *POSITION,
        F.regexp_replace("line", "^data: ?", "").alias("data"),
        blank.alias("is_end"),
        F.sum(ends).over(so_far).alias("nth"),
        F.sum(ends).over(block).alias("ends"),
    )

    # Grouping by block and number keeps the partitioning by block: no second shuffle.
    local = (
        numbered.where(~F.col("is_end"))
        .groupBy(*BLOCK, "nth", "ends")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "data"))).alias("rows"))
        .select(*BLOCK, F.col("rows")[0]["seq"].alias("seq"), "nth", "ends", F.col("rows.data").alias("data"))
    )
    inside = (F.col("nth") > 0) & (F.col("nth") < F.col("ends"))
    whole = local.where(inside).select(*POSITION, "data")

    # First and last event of a block may go on in its neighbours: join them by their number in
    # the file. These are two rows per block.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = numbered.groupBy(*BLOCK).agg(F.max("ends").alias("ends"))
    starts = blocks.withColumn(
        "start", F.coalesce(F.sum("ends").over(before), F.lit(0).cast("bigint"))
    ).drop("ends")
    parts = local.where(~inside).join(starts, BLOCK)
    cut = (
        parts.groupBy("file", (F.col("start") + F.col("nth")).alias("number"))
        .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "data"))).alias("rows"))
        .select(
            "file",
            F.col("rows")[0]["block"].alias("block"),
            F.col("rows")[0]["seq"].alias("seq"),
            F.flatten(F.col("rows.data")).alias("data"),
        )
    )
    payloads = whole.unionByName(cut).select(_joined(F.col("data")).alias("payload"), *POSITION)
    rows = payloads.where(F.col("payload") != "")
    return rows if position else rows.select("payload")
