"""Consumer lag: committed next offsets against the high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water(log: DataFrame) -> DataFrame:
    """Next free offset per partition of a topic's rows."""
    return log.groupBy("partition").agg((F.max("offset") + 1).alias("high"))


def compute_lag(partitions: DataFrame, committed: DataFrame, high: DataFrame) -> DataFrame:
    """Lag per partition, by partition. A partition without a commit (or -1) counts from 0, one
    without rows has high-water 0, and lag is never negative."""
    none = F.lit(0).cast("bigint")
    joined = partitions.select("partition").join(committed, "partition", "left")
    joined = joined.join(high, "partition", "left")
    done = F.greatest(F.coalesce(F.col("committed"), none), none)
    top = F.coalesce(F.col("high"), none)
    return joined.select(
        "partition",
        done.alias("committed"),
        top.alias("high"),
        F.greatest(top - done, none).alias("lag"),
    ).orderBy("partition")


def total_lag(lag: DataFrame) -> DataFrame:
    """Sum of the lag over all partitions."""
    return lag.agg(F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"))
