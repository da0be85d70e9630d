"""Key filter and the one-output-per-message router."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.operators.decode import classify, dead_letter_fields, encode, with_page_key


def keyable(df: DataFrame, payload: str = "value") -> DataFrame:
    """Rows whose payload yields a page key, with that key as ``page_key``; others are skipped."""
    return with_page_key(df, payload).where(F.col("page_key").isNotNull())


def produced(payloads: DataFrame, payload: str = "payload", *keep: str) -> DataFrame:
    """Captured payloads as messages for the raw topic, bytes untouched."""
    return keyable(payloads, payload).select(
        F.col("page_key").cast("binary").alias("key"),
        F.col(payload).cast("binary").alias("value"),
        F.lit(S.TOPIC_RAW).alias("topic"),
        *keep,
    )


def route(raw_log: DataFrame, *keep: str) -> DataFrame:
    """Every raw log row as one message for the validated or the dead-letter topic.

    One pass and one DataFrame: the topic is a column, so a single write serves both topics and
    no payload is decoded twice. The source key is kept on both sides; source coordinates stay
    available as ``source_partition`` and ``source_offset`` for ordering.
    """
    valid = F.col("reason").isNull()
    judged = classify(raw_log)
    body = F.when(valid, encode(*S.ENVELOPE_COLUMNS)).otherwise(encode(*dead_letter_fields()))
    return judged.select(
        "key",
        body.cast("binary").alias("value"),
        F.when(valid, S.TOPIC_VALIDATED).otherwise(S.TOPIC_DEAD_LETTER).alias("topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        *keep,
    )
