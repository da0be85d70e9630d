"""Scans of the Parquet lake, the text backup and the analytics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog import schema as S
from ripplelog.files import exists
from ripplelog.session import workspace

LAKE = T.StructType(
    [
        *S.ENVELOPE.fields,
        T.StructField("dt", T.DateType()),
        T.StructField("p", T.IntegerType()),
        T.StructField("rng", T.StringType()),
    ]
)


def lake_folder(root: str) -> str:
    return f"{root}/lake"


def backup_folder(root: str) -> str:
    return f"{root}/raw"


def lake(spark: SparkSession, root: str) -> DataFrame:
    """Lake rows with the typed folder columns ``dt`` and ``p``; predicates on them skip folders.

    The schema is fixed, so no file is opened for inference.
    """
    return spark.read.schema(LAKE).parquet(lake_folder(root)).drop("rng")


def backup(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Backup lines as columns. The schema is inferred, which reads everything once; pass one to
    avoid that."""
    reader = spark.read if schema is None else spark.read.schema(
        T.StructType(
            [
                *schema.fields,
                T.StructField("topic", T.StringType()),
                T.StructField("p", T.IntegerType()),
                T.StructField("rng", T.StringType()),
            ]
        )
    )
    return reader.json(backup_folder(root)).drop("rng")


def backup_lines(spark: SparkSession, root: str) -> DataFrame:
    """Backup lines verbatim, with their folder columns and their position in the object."""
    lines = spark.read.text(backup_folder(root)).withColumns(
        {"file": F.col("_metadata.file_path"), "seq": F.monotonically_increasing_id()}
    )
    return lines


RUNS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rng", T.StringType()),
    ]
)


def runs_folder(root: str) -> str:
    return f"{root}/runs"


def backup_runs(spark: SparkSession, root: str) -> DataFrame:
    """Manifest of a backup: the offset runs (lo, hi, rows) of each object."""
    if not exists(spark, runs_folder(root)):
        rows = spark.createDataFrame([], RUNS)
    else:
        rows = spark.read.schema(RUNS).parquet(runs_folder(root)).select(RUNS.fieldNames())
    return rows.withColumnRenamed("partition", "p").distinct()


def _stretches(runs: DataFrame) -> DataFrame:
    """Of objects whose offset ranges overlap others': the stretches of lines between which lines of
    another object belong, with their first offset ``at``, first line and number of lines."""
    group, so_far = ["topic", "p"], (Window.unboundedPreceding, Window.currentRow)
    objects = runs.groupBy(*group, "rng").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    in_order = Window.partitionBy(*group).orderBy("lo")
    reached = F.max("hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("lo") <= reached, 0).otherwise(1)
    islands = objects.withColumn("apart", apart).withColumn("island", F.sum("apart").over(in_order.rowsBetween(*so_far)))
    size = F.count(F.lit(1)).over(Window.partitionBy(*group, "island"))
    shared = islands.withColumn("size", size).where("size > 1").select(*group, "rng", "island")

    mixed = runs.join(shared, [*group, "rng"])
    own = Window.partitionBy(*group, "rng").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy(*group, "island").orderBy("lo")
    other = F.when(F.col("rng") == F.lag("rng").over(island), 0).otherwise(1)
    numbered = (
        mixed.withColumn("line", F.coalesce(F.sum("rows").over(own), F.lit(0)))
        .withColumn("other", other)
        .withColumn("stretch", F.sum("other").over(island.rowsBetween(*so_far)))
    )
    return numbered.groupBy(*group, "rng", "stretch").agg(
        F.min("lo").alias("at"), F.min("line").alias("line"), F.sum("rows").alias("lines")
    ).drop("stretch")


def ordered_lines(spark: SparkSession, root: str) -> DataFrame:
    """Backup lines with (``at``, ``file``, ``seq``), which sort like the offsets they had in their
    partition.

    ``at`` is the first offset of a stretch of lines that no other object interrupts, usually a whole
    object. Objects interrupt each other only if a consumer met offsets out of order; then, lines
    of just these objects are numbered, file by file, and matched with the manifest.
    """
    lines = backup_lines(spark, root).withColumn("at", F.substring("rng", 1, 20).cast("bigint"))
    columns = [*lines.columns]
    staged = workspace(spark, "stretches")
    stretches = _stretches(backup_runs(spark, root))
    stretches.write.parquet(staged)
    stretches = spark.read.schema(stretches.schema).parquet(staged)
    if stretches.isEmpty():
        return lines
    key = ["topic", "p", "rng"]
    mixed = stretches.select(*key).distinct()
    shared = lines.join(mixed, key, "left_semi").drop("at")
    sizes = shared.groupBy(*key, "file").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(*key).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*key, "file", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("bigint")).alias("first"))
    within = Window.partitionBy(*key, "file").orderBy("seq")
    numbered = shared.join(firsts, [*key, "file"]).withColumn("nth", F.col("first") + F.row_number().over(within) - 1)
    numbered = numbered.drop("first")
    inside = (F.col("nth") >= F.col("s.line")) & (F.col("nth") < F.col("s.line") + F.col("s.lines"))
    same = [F.col(f"l.{name}") == F.col(f"s.{name}") for name in key]
    found = numbered.alias("l").join(stretches.alias("s"), [*same, inside], "left")
    lost = F.raise_error(F.lit("a backup line is in no run of the manifest")).cast("bigint")
    placed = found.select("l.*", F.coalesce("s.at", lost).alias("at")).withColumn("seq", F.col("nth"))
    return lines.join(mixed, key, "left_anti").select(columns).unionByName(placed.select(columns))
