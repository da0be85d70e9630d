"""SQL with the same result as each registered query, for DuckDB over the same tables.

The pipeline's rules are written here a second time with DuckDB's own JSON and window functions.
"""

from __future__ import annotations

from ripplelog import schema as S
from ripplelog.plans.fixture import oracle_ctes

_RAW, _VALID, _DEAD = S.TOPIC_RAW, S.TOPIC_VALIDATED, S.TOPIC_DEAD_LETTER

_PAGES = "SELECT wiki, title, edit_count, bot_edit_count, last_event_at, last_user FROM pages_of"
_STATS = """SELECT wiki, total_events, bot_events, human_events, last_event_at FROM stats_of
ORDER BY total_events DESC, wiki"""

_TIME = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(occurred_at)"
_DAY = f"CAST({_TIME} AS DATE)"

_BY_TYPE = """SELECT event_type, count(*) AS c FROM envelopes
GROUP BY event_type ORDER BY c DESC, event_type"""

_LABEL = "lpad(CAST({lo} AS varchar), 20, '0') || '-' || lpad(CAST({hi} AS varchar), 20, '0')"

_JSON = """CAST(json_object('event_id', event_id, 'event_type', event_type, 'wiki', wiki,
  'title', title, 'user', "user", 'bot', bot, 'occurred_at', occurred_at) AS varchar)"""

_LAKE = f"""SELECT event_id, event_type, wiki, title, "user", bot, occurred_at,
  {_DAY} AS dt, partition AS p FROM envelopes"""

# Offsets of the routed topics: valid rows are renumbered per partition, dead letters overall.
_ROUTED = f"""SELECT '{_VALID}' AS topic, partition, count(*) AS n
  FROM judged WHERE reason IS NULL GROUP BY partition
UNION ALL
SELECT '{_DEAD}', 0, count(*) FROM judged WHERE reason IS NOT NULL"""

_RAW_RANGES = f"SELECT '{_RAW}' AS topic, partition, count(*) AS n FROM raw_log GROUP BY partition"


def _ranges(counts: str) -> str:
    label = _LABEL.format(lo="0", hi="n - 1")
    return f"""SELECT topic, partition, CAST(0 AS BIGINT) AS lo, n - 1 AS hi, n AS "rows",
  {label} AS label FROM ({counts}) WHERE n > 0"""


_RENUMBERED = """SELECT event_id, event_type, wiki, title, "user", bot, occurred_at, partition,
  row_number() OVER (PARTITION BY partition ORDER BY "offset") - 1 AS "offset" FROM envelopes"""

_LAG = """SELECT h.partition,
  CASE h.partition WHEN 4 THEN 0 WHEN 5 THEN 0 ELSE coalesce(c.done, 0) END AS committed,
  h.high,
  h.high - CASE h.partition WHEN 4 THEN 0 WHEN 5 THEN 0 ELSE coalesce(c.done, 0) END AS lag
FROM (
  SELECT ids.partition, coalesce(n, 0) AS high
  FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS partition) ids
  LEFT JOIN (SELECT partition, max("offset") + 1 AS n FROM raw_log GROUP BY partition) r
    ON r.partition = ids.partition
) h
LEFT JOIN (
  SELECT partition, max("offset") + 1 AS done FROM raw_log WHERE arrival < 500001
  GROUP BY partition
) c ON c.partition = h.partition"""


# Raw topic under offsets with gaps: next free offset and first deliveries of each partition.
_SPARSE = """(SELECT CAST(unnest(range(6)) AS INTEGER) AS partition) ids LEFT JOIN (
  SELECT partition, max(arrival * 4000000000000 + event_id) + 1 AS high,
         count(*) FILTER (redelivery = 0) AS first
  FROM raw_log GROUP BY partition) r ON r.partition = ids.partition"""


def _bodies() -> dict[str, str]:
    keyed = """coalesce(try_cast(doc->>'$.wiki' AS varchar), '') <> ''
      AND coalesce(try_cast(doc->>'$.title' AS varchar), '') <> ''
      AND json_type(doc) = 'OBJECT'
      AND json_type(doc, '$.wiki') = 'VARCHAR' AND json_type(doc, '$.title') = 'VARCHAR'"""
    key = "(doc->>'$.wiki') || ':' || (doc->>'$.title')"
    produced = f"SELECT {key} AS key, partition, payload AS value FROM parsed WHERE {keyed}"
    return {
        "top_pages": f"{_PAGES} ORDER BY edit_count DESC, wiki, title LIMIT 10",
        "page_key": f"""SELECT event_id, redelivery, CASE WHEN {keyed} THEN {key} END AS page_key
          FROM parsed""",
        "keyable_events": f"SELECT {key} AS page_key, payload AS value FROM parsed WHERE {keyed}",
        "decoded_events": """SELECT CAST(doc->>'$.id' AS BIGINT) AS id,
          doc->>'$.meta.domain' AS domain, doc->>'$.comment' AS comment,
          coalesce(CAST(doc->>'$.minor' AS BOOLEAN), false) AS minor,
          CAST(doc->>'$.length.new' AS BIGINT) AS length_new,
          CAST(doc->>'$.revision.old' AS BIGINT) AS revision_old FROM typed WHERE decode_ok""",
        "validated_envelopes": """SELECT event_id, event_type, wiki, title, "user", bot, occurred_at
          FROM envelopes""",
        "encoded_envelopes": f"SELECT {_JSON} AS value FROM envelopes",
        "dead_letters": f"""SELECT reason, '{_RAW}' AS source_topic, partition, "offset",
          payload AS raw FROM judged WHERE reason IS NOT NULL""",
        "dead_letter_reasons": """SELECT reason,
          CASE WHEN decode_ok THEN 'invalid' ELSE 'decode' END AS error_class, count(*) AS "rows"
          FROM judged WHERE reason IS NOT NULL GROUP BY ALL""",
        "route_counts": f"""SELECT CASE WHEN reason IS NULL THEN '{_VALID}' ELSE '{_DEAD}' END
          AS topic, count(*) AS "rows" FROM judged GROUP BY ALL""",
        "wiki_stats": _STATS,
        "read_model_counts": """SELECT (SELECT count(*) FROM pages_of) AS pages,
          (SELECT count(*) FROM unique_events) AS processed_events""",
        "processed_events": "SELECT event_id, occurred_at AS processed_at FROM unique_events",
        "page_activity": _PAGES,
        "page_lookup": f"{_PAGES} WHERE wiki = 'enwiki' AND title = 'Page 0'",
        "new_events_anti_join": """SELECT event_id, wiki, title, occurred_at FROM unique_events
          WHERE event_id NOT IN (SELECT event_id FROM envelopes WHERE occurred_at < 1705276800)""",
        "total_events": "SELECT count(*) AS total FROM envelopes",
        "events_by_type": _BY_TYPE,
        "throughput_per_minute": f"""SELECT date_trunc('minute', {_TIME}) AS time,
          count(*) AS events FROM envelopes GROUP BY ALL ORDER BY time""",
        "top_wikis": """SELECT wiki, count(*) AS c FROM envelopes GROUP BY wiki
          ORDER BY c DESC, wiki LIMIT 5""",
        "latest_events": f"""SELECT {_TIME} AS occurred_at, wiki, event_type, "user", title
          FROM envelopes ORDER BY {_TIME} DESC, partition DESC, "offset" DESC LIMIT 10""",
        "events_table_since": f"""SELECT wiki, event_type, count(*) AS c, max({_TIME}) AS last_at
          FROM envelopes WHERE {_TIME} >= TIMESTAMP '2024-01-15 00:00:00'
          GROUP BY wiki, event_type""",
        "partition_assignment": """SELECT page, count(*) AS "rows", partition FROM raw_log
          GROUP BY page, partition""",
        "offset_ranges_per_partition": _ranges(_RAW_RANGES),
        "log_topics": """SELECT DISTINCT topic FROM (%s UNION ALL %s) WHERE n > 0 ORDER BY topic"""
        % (_RAW_RANGES, _ROUTED),
        "log_append": _ranges(f"{_RAW_RANGES} UNION ALL {_ROUTED}"),
        "validated_log_events": _RENUMBERED,
        "lake_daily_counts": f"""SELECT {_DAY} AS dt, partition AS p, count(*) AS "rows"
          FROM envelopes GROUP BY ALL""",
        "lake_one_day": f"SELECT * FROM ({_LAKE}) WHERE dt = DATE '2024-01-15'",
        "lake_top_wikis": """SELECT wiki, count(*) AS c FROM envelopes GROUP BY wiki
          ORDER BY c DESC, wiki LIMIT 10""",
        "backup_round_trip": """SELECT event_id, event_type, wiki, title, "user", bot, occurred_at,
          partition AS p FROM envelopes""",
        "backup_rewritten": "SELECT partition AS p, count(*) AS lines FROM envelopes GROUP BY partition",
        "inspect_report": f"""SELECT *, (SELECT count(*) FROM pages_of) AS pages,
          (SELECT count(*) FROM unique_events) AS processed_events
          FROM ({_PAGES}) ORDER BY edit_count DESC, wiki, title LIMIT 10""",
        "restore_round_trip": f"""SELECT *, wiki || ':' || title AS key FROM ({_RENUMBERED})""",
        "stream_page_activity": _PAGES,
        "stream_wiki_stats": _STATS,
        "stream_ledger": "SELECT event_id, occurred_at AS processed_at FROM unique_events",
        "stream_routed": _ranges(_ROUTED),
        "stream_lake": _LAKE,
        "stream_backup": f"SELECT {_JSON} AS value, partition AS p FROM envelopes",
        "stream_ingest": _BY_TYPE,
        "replay_is_noop": """SELECT (SELECT count(*) FROM pages_of) AS pages,
          (SELECT count(*) FROM unique_events) AS processed_events,
          CAST(0 AS BIGINT) AS applied_again, (SELECT count(*) FROM envelopes) AS skipped_again""",
        "rebuild_equals": """SELECT wiki, title, edit_count, bot_edit_count, last_event_at,
          last_user, CAST(2 AS BIGINT) AS sides FROM pages_of""",
        "run_counters": """SELECT (SELECT count(*) FROM envelopes) AS validated,
          (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS dead_lettered,
          (SELECT count(*) FROM unique_events) AS applied,
          (SELECT count(*) FROM envelopes) - (SELECT count(*) FROM unique_events) AS skipped""",
        "lag": f"{_LAG} ORDER BY h.partition",
        "total_lag": f"SELECT CAST(sum(lag) AS BIGINT) AS total_lag FROM ({_LAG})",
        "group_lag_drained": """SELECT ids.partition, coalesce(n, 0) AS committed,
          coalesce(n, 0) AS high, CAST(0 AS BIGINT) AS lag
          FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS partition) ids LEFT JOIN (
            SELECT partition, count(*) AS n FROM envelopes GROUP BY partition) r
          ON r.partition = ids.partition ORDER BY ids.partition""",
        "backup_counters": """SELECT CAST(count(*) AS BIGINT) AS "rows", true AS few_objects FROM envelopes""",
        "throughput_running": f"""SELECT date_trunc('minute', {_TIME}) AS time,
          count(*) AS events FROM envelopes GROUP BY ALL ORDER BY time""",
        "latest_events_stored": f"""SELECT {_TIME} AS occurred_at, wiki, event_type FROM envelopes
          ORDER BY {_TIME} DESC, partition DESC, "offset" DESC LIMIT 10""",
        "ingest_with_broken": """SELECT count(*) AS "rows", CAST(10 AS BIGINT) AS broken FROM envelopes""",
        "stored_page_lookup": f"{_PAGES} WHERE wiki = 'enwiki' AND title = 'Page 0'",
        "state_audit": """SELECT count(*) AS state_ids, count(*) AS ledger_ids, CAST(0 AS BIGINT) AS only_state,
          CAST(0 AS BIGINT) AS only_ledger FROM unique_events""",
        "ingest_time_default": """SELECT count(*) AS "rows", count(*) AS in_time FROM envelopes""",
        "retry_after_failure": """SELECT count(*) AS lines, count(*) AS left_by_failure,
          CAST(0 AS BIGINT) AS left_at_end FROM envelopes""",
        "bounded_flushes": """SELECT partition AS p, CAST(count(*) AS BIGINT) AS lines, true AS within
          FROM envelopes GROUP BY partition""",
        "bounded_run": "SELECT count(*) AS lines, count(*) AS handled, true AS reported FROM envelopes",
        "poison_fails": """SELECT (SELECT count(*) FROM pages_of) AS pages,
          (SELECT count(*) FROM unique_events) AS processed_events, true AS stopped""",
        "lag_on_gaps": f"""SELECT ids.partition, coalesce(high, 0) AS committed, coalesce(high, 0) AS high,
          CAST(0 AS BIGINT) AS rows_left, CAST(0 AS BIGINT) AS lag FROM {_SPARSE}""",
        "lag_out_of_order": f"""SELECT ids.partition, CAST(0 AS BIGINT) AS committed, coalesce(high, 0) AS high,
          coalesce(first, 0) AS rows_left, coalesce(high, 0) AS lag FROM {_SPARSE}""",
        "lag_after_each_batch": """SELECT CAST(0 AS BIGINT) AS last_lag,
          CAST(count(*) AS BIGINT) AS "rows", count(*) AS lines FROM envelopes""",
        "null_key_routing": f"""SELECT CASE WHEN reason IS NULL THEN '{_VALID}' ELSE '{_DEAD}' END
          AS topic, event_id % 3 = 0 AS no_key, count(*) AS "rows" FROM judged GROUP BY ALL""",
        "restore_verbatim": f"""SELECT '{_RAW}' AS topic, CASE WHEN {keyed} THEN {key} END AS key,
          payload AS value FROM parsed""",
        "limited_backup_order": "SELECT wiki, title, count(*) AS in_order FROM envelopes GROUP BY ALL",
        "sse_payloads": "SELECT payload FROM raw_log",
        "sse_server_payloads": "SELECT payload FROM raw_log",
        "sse_stream_payloads": "SELECT payload FROM raw_log",
        "produced_log": produced,
        "stream_produced": produced,
    }


def oracle() -> dict[str, str]:
    ctes = oracle_ctes()
    return {name: ctes + body for name, body in _bodies().items()}
