"""Time arithmetic on unix seconds that gives the same result in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Seconds at the end of 9999-12-31; a source that sends milliseconds exceeds it.
_LAST_DAY_END = 253_402_300_799

# Largest value of a 32-bit unsigned datetime, at which the OLAP column saturates.
_LAST_DATETIME = 4_294_967_295


def utc_date(seconds: Column) -> Column:
    """UTC calendar day of unix seconds; times after year 9999 are filed under its last day."""
    bounded = F.least(seconds, F.lit(_LAST_DAY_END))
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(bounded / 86400).cast("int"))


def utc_timestamp(seconds: Column) -> Column:
    """Unix seconds as a zone-free timestamp, saturating like a 32-bit datetime."""
    bounded = F.greatest(F.lit(0), F.least(seconds, F.lit(_LAST_DATETIME)))
    return F.expr(_EPOCH) + F.make_dt_interval(secs=bounded.cast("decimal(18,6)"))


def unix_seconds(timestamp: Column) -> Column:
    """Whole unix seconds of a zone-free timestamp."""
    whole = (timestamp - F.expr(_EPOCH)).cast("interval second")
    return F.floor(whole.cast("decimal(18,6)")).cast("bigint")


def minute_start(timestamp: Column) -> Column:
    """Zone-free timestamp cut to its minute (``date_trunc`` would return a zoned one)."""
    return timestamp - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), timestamp))


def utc_now() -> Column:
    """Current time as a zone-free UTC timestamp in whole seconds; fixed per query or micro-batch."""
    return utc_timestamp(F.unix_timestamp(F.current_timestamp()))
