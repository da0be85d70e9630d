"""Raw change events derived from the ``events`` table, in Spark and as SQL for the oracle.

Every event is delivered once and every 25th again, then with another user, bot flag and time. Some
deliveries carry a defect: cut text, text after the document, a wrong type in a used, an unused or a
nested field, or a missing field. ``FIXTURES.md`` lists the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions.keys import partition_for
from ripplelog.functions.times import unix_seconds
from ripplelog.operators.decode import classify, to_envelope
from ripplelog.operators.offsets import assign_offsets
from ripplelog.sinks.log import append_log, mirror_log

ARRIVALS = 1_000_003
CHUNK_ROWS = 50_000

# Column expressions both engines read the same way; {text} is the text type's name.
COLUMNS = {
    "arrival": "redelivery * 1000003 + (event_id * 7919) % 1000003",
    "wiki": "CASE user_id % 5 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'dewiki' WHEN 2 THEN 'frwiki'"
    " WHEN 3 THEN 'commonswiki' ELSE 'wikidatawiki' END",
    "title": "concat('Page ', CAST(user_id % 40 AS {text}))",
    "editor": "concat('User ', CAST((event_id + 5 * redelivery) % 17 AS {text}))",
    "bot": "(event_id + redelivery) % 4 = 0",
    "defect": "event_id % 50",
}

DOCUMENT = """concat(
  '{{"$schema":"/mediawiki/recentchange/1.0.0","meta":{{',
  CASE WHEN defect = 11 THEN '' ELSE concat('"id":"ev-', CAST(event_id AS {text}), '",') END,
  '"domain":"', wiki, '.example.org","stream":"recentchange","dt":"', CAST(seconds AS {text}),
  '","partition":0}},"id":', CAST(event_id AS {text}),
  ',"type":"', CASE WHEN defect = 13 THEN '' ELSE event_type END,
  '","namespace":0',
  CASE WHEN defect = 17 THEN '' ELSE concat(',"title":"', title, '"') END,
  ',"title_url":"https://', wiki, '.example.org/', CAST(user_id AS {text}),
  '","comment":"edit of ', event_type, '","timestamp":',
  CASE WHEN defect = 29 THEN '0' WHEN defect = 31 THEN concat('"', CAST(seconds AS {text}), '"')
       ELSE CAST(seconds + 60 * redelivery AS {text}) END,
  ',"user":"', CASE WHEN defect = 23 THEN '' ELSE editor END,
  '","bot":', CASE WHEN bot THEN 'true' ELSE 'false' END,
  CASE WHEN defect = 43 THEN ',"length":{{"old":"1"}}' WHEN event_id % 3 = 0 THEN ''
       ELSE concat(',"minor":true,"length":{{"old":', CAST(event_id % 900 AS {text}), ',"new":',
                   CAST(event_id % 900 + 7 AS {text}), '}},"revision":{{"old":',
                   CAST(event_id AS {text}), ',"new":', CAST(event_id + 1 AS {text}), '}}') END,
  ',"server_name":', CASE WHEN defect = 41 THEN '7' ELSE concat('"', wiki, '.example.org"') END,
  ',"server_url":"https://', wiki, '.example.org"',
  CASE WHEN defect = 19 THEN '' ELSE concat(',"wiki":"', wiki, '"') END,
  '}}')"""

PAYLOAD = """CASE WHEN defect = 7 THEN substr(document, 1, length(document) - 10)
  WHEN defect = 37 THEN concat(document, 'xyz') ELSE document END"""


def _spread(events: DataFrame) -> DataFrame:
    """Deal the rows of a table to tasks of at most ``CHUNK_ROWS`` rows, one for each core at least.

    Splits of a file say little: one without a row group is empty, and one row group may hold all rows.
    """
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(max(cores, -(-events.count() // CHUNK_ROWS)))  # of a whole table, from the footers


def deliveries(spark: SparkSession, sf_dir: str, redelivery: int | None = None) -> DataFrame:
    """One row per delivery with its payload, key, partition and place in arrival order; of all, or of
    the first deliveries (0) or the redeliveries (1), for which other events aren't dealt out."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    repeated = F.col("event_id") % 25 == 3
    events = _spread(events.where(repeated) if redelivery == 1 else events)
    both = F.when(repeated, F.expr("array(0L, 1L)")).otherwise(F.expr("array(0L)"))
    again = both if redelivery is None else F.array(F.lit(redelivery).cast("bigint"))
    rows = events.select(
        "event_id",
        "user_id",
        "event_type",
        unix_seconds(F.col("ts")).alias("seconds"),
        F.explode(again).alias("redelivery"),
    )
    rows = rows.withColumns(
        {name: F.expr(expression.format(text="string")) for name, expression in COLUMNS.items()}
    ).withColumn("document", F.expr(DOCUMENT.format(text="string")))
    return rows.select(
        "event_id",
        "redelivery",
        "arrival",
        "wiki",
        "title",
        "seconds",
        F.expr(PAYLOAD).alias("payload"),
        F.concat("wiki", F.lit(":"), "title").alias("page"),
    ).withColumn("partition", partition_for(F.col("page"), S.TOPIC_PARTITIONS[S.TOPIC_RAW]))


def _log_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "key": F.col("page").cast("binary"),
            "value": F.col("payload").cast("binary"),
            "topic": F.lit(S.TOPIC_RAW),
            "timestamp": F.timestamp_seconds("seconds"),
        }
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw topic with increasing offsets that have gaps, as on a log that drops old messages.

    Enough wherever only the order of offsets matters; costs no shuffle.
    """
    position = F.col("arrival") * 4_000_000_000_000 + F.col("event_id")
    return _log_columns(deliveries(spark, sf_dir)).withColumn("offset", position)


def _chunked(spark: SparkSession, sf_dir: str, redelivery: int | None = None) -> DataFrame:
    """Deliveries with a chunk of the arrival order that holds about ``CHUNK_ROWS`` rows at any
    scale (the row count comes from the Parquet footers)."""
    total = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    width = max(1, 2 * ARRIVALS * CHUNK_ROWS // max(1, total))
    chunk = F.col("arrival") - F.col("arrival") % width
    return _log_columns(deliveries(spark, sf_dir, redelivery)).withColumn("chunk", chunk)


ORDER = ["arrival", "event_id"]


def dense_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw topic with gap-free offsets."""
    return assign_offsets(_chunked(spark, sf_dir), ORDER, ["chunk"])


def write_raw_topic(spark: SparkSession, sf_dir: str, root: str, segments: int = 1) -> None:
    """Write the raw topic as a file log: all of it at once, or first deliveries before redeliveries."""
    if segments == 1:
        append_log(_chunked(spark, sf_dir), root, "seed-0", ORDER, ["chunk"])
        return
    for redelivery in (0, 1):
        append_log(_chunked(spark, sf_dir, redelivery), root, f"seed-{redelivery}", ORDER, ["chunk"])


def mirror_raw_topic(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The raw topic under its own offsets, which have gaps: first deliveries, then redeliveries.

    Rows of a log partition are gathered in tasks whose size Spark bounds, so that files are few."""
    rows = raw_log(spark, sf_dir).drop("chunk")
    for redelivery in (0, 1):
        part = rows.where(F.col("redelivery") == redelivery).hint("rebalance", "partition")
        mirror_log(part, root, f"seed-{redelivery}")


def events_of(log: DataFrame) -> DataFrame:
    """Envelopes of a raw log with their log position, redeliveries included."""
    return to_envelope(classify(log), "partition", "offset")


def oracle_ctes() -> str:
    """The same rows as DuckDB common table expressions, ending in ``raw_log`` and ``judged``."""
    columns = "".join(f",\n  {sql.format(text='varchar')} AS {name}" for name, sql in COLUMNS.items())
    return f"""WITH counted AS (
  SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
         unnest(CASE WHEN event_id % 25 = 3 THEN [0, 1] ELSE [0] END)::BIGINT AS redelivery
  FROM events
), derived AS (
  SELECT event_id, user_id, event_type, seconds, redelivery{columns}
  FROM counted
), written AS (
  SELECT *, {DOCUMENT.format(text="varchar")} AS document,
         concat(wiki, ':', title) AS page
  FROM derived
), raw_log AS (
  SELECT event_id, redelivery, arrival, seconds, page, {PAYLOAD} AS payload,
         CAST(CAST('0x' || substr(md5(page), 1, 8) AS BIGINT) % 6 AS INTEGER) AS partition,
         row_number() OVER (
           PARTITION BY CAST('0x' || substr(md5(page), 1, 8) AS BIGINT) % 6
           ORDER BY arrival, event_id) - 1 AS "offset"
  FROM written
), parsed AS (
  SELECT *, CASE WHEN json_valid(payload) THEN payload::JSON END AS doc FROM raw_log
), typed AS (
  SELECT *,
    doc IS NOT NULL AND json_type(doc) = 'OBJECT'
    AND coalesce(json_type(doc, '$.meta') IN ('OBJECT', 'NULL'), true)
    AND coalesce(json_type(doc, '$.meta.id') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.type') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.title') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.wiki') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.user') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.bot') IN ('BOOLEAN', 'NULL'), true)
    AND coalesce(json_type(doc, '$.server_name') IN ('VARCHAR', 'NULL'), true)
    AND coalesce(json_type(doc, '$.length') IN ('OBJECT', 'NULL'), true)
    AND coalesce(json_type(doc, '$.length.old') IN ('BIGINT', 'UBIGINT', 'NULL'), true)
    AND coalesce(json_type(doc, '$.timestamp') IN ('BIGINT', 'UBIGINT', 'NULL'), true) AS decode_ok,
    coalesce(doc->>'$.meta.id', '') AS ev_id,
    coalesce(doc->>'$.type', '') AS ev_type,
    coalesce(doc->>'$.wiki', '') AS ev_wiki,
    coalesce(doc->>'$.title', '') AS ev_title,
    coalesce(doc->>'$.user', '') AS ev_user,
    coalesce(try_cast(doc->>'$.bot' AS BOOLEAN), false) AS ev_bot,
    coalesce(try_cast(doc->>'$.timestamp' AS BIGINT), 0) AS ev_time
  FROM parsed
), judged AS (
  SELECT *,
    CASE WHEN NOT decode_ok THEN '{S.DECODE_REASON}'
         WHEN ev_id = '' THEN '{S.MISSING_ID}'
         WHEN ev_type = '' THEN '{S.MISSING_TYPE}'
         WHEN ev_title = '' THEN '{S.MISSING_TITLE}'
         WHEN ev_wiki = '' THEN '{S.MISSING_WIKI}'
         WHEN ev_user = '' THEN '{S.MISSING_USER}'
         WHEN ev_time <= 0 THEN '{S.BAD_TIMESTAMP}' END AS reason
  FROM typed
), envelopes AS (
  SELECT partition, "offset", arrival, ev_id AS event_id, ev_type AS event_type, ev_wiki AS wiki,
         ev_title AS title, ev_user AS "user", ev_bot AS bot, ev_time AS occurred_at
  FROM judged WHERE reason IS NULL
), unique_events AS (
  SELECT * FROM envelopes
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY partition, "offset") = 1
), pages_of AS (
  SELECT wiki, title, count(*) AS edit_count, CAST(sum(bot::BIGINT) AS BIGINT) AS bot_edit_count,
         max(occurred_at) AS last_event_at, arg_max("user", "offset") AS last_user
  FROM unique_events GROUP BY wiki, title
), stats_of AS (
  SELECT wiki, count(*) AS total_events, CAST(sum(bot::BIGINT) AS BIGINT) AS bot_events,
         CAST(sum(1 - bot::BIGINT) AS BIGINT) AS human_events, max(occurred_at) AS last_event_at
  FROM unique_events GROUP BY wiki
)
"""
