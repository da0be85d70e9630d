"""Page keys, partitions and offset-range labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_key(wiki: Column, title: Column) -> Column:
    """``wiki:title``, or null when either part is missing or empty."""
    return F.when((wiki != "") & (title != ""), F.concat(wiki, F.lit(":"), title))


def partition_for(key: Column, partitions: Column | int) -> Column:
    """Stable partition number of a key: leading 32 bits of its md5, modulo the partition count."""
    count = F.lit(partitions) if isinstance(partitions, int) else partitions
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (head % count).cast("int")


def range_label(low: Column, high: Column) -> Column:
    """Offset range as two 20-digit numbers, so that names sort like offsets."""
    return F.concat_ws("-", *[F.lpad(end.cast("string"), 20, "0") for end in (low, high)])
