import json

from ripplelog import schema as S


def payload(**changes):
    """A valid raw event; a change to ``...`` removes the field, ``meta_id`` sets ``meta.id``."""
    event = {
        "$schema": "/mediawiki/recentchange/1.0.0",
        "meta": {"id": "e-1", "domain": "x.example.org", "stream": "s", "dt": "d", "partition": 0},
        "id": 7,
        "type": "edit",
        "namespace": 0,
        "title": "Ada",
        "comment": "c",
        "timestamp": 1_700_000_000,
        "user": "bob",
        "bot": False,
        "wiki": "enwiki",
    }
    if "meta_id" in changes:
        event["meta"]["id"] = changes.pop("meta_id")
    for name, value in changes.items():
        if value is ...:
            event.pop(name)
        else:
            event[name] = value
    return json.dumps(event, separators=(",", ":"))


def raw_rows(spark, payloads, topic=S.TOPIC_RAW):
    """Payload texts as log rows of one partition, offsets in list order."""
    rows = [(b"k", text.encode(), topic, 0, number) for number, text in enumerate(payloads)]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset bigint"
    )


def envelope_rows(spark, rows):
    """(event_id, wiki, title, user, bot, occurred_at) tuples as events in arrival order."""
    full = [
        (event_id, "edit", wiki, title, user, bot, time, S.TOPIC_VALIDATED, 0, number)
        for number, (event_id, wiki, title, user, bot, time) in enumerate(rows)
    ]
    return spark.createDataFrame(
        full,
        "event_id string, event_type string, wiki string, title string, user string, bot boolean,"
        " occurred_at bigint, topic string, partition int, offset bigint",
    )


def validated_messages(spark, rows):
    """The same tuples as encoded messages, with ``n`` as their order."""
    from pyspark.sql import functions as F

    from ripplelog.operators.decode import encode

    return envelope_rows(spark, rows).select(
        F.concat("wiki", F.lit(":"), "title").cast("binary").alias("key"),
        encode(*S.ENVELOPE_COLUMNS).cast("binary").alias("value"),
        "topic",
        F.col("offset").alias("n"),
    )
