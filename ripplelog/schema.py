"""Names, types and texts shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names and partition counts; then the names of the consumer groups.
TOPIC_RAW = "wikimedia.recentchange.raw"
TOPIC_VALIDATED = "wikimedia.recentchange.validated"
TOPIC_DEAD_LETTER = "wikimedia.dead_letter"
TOPIC_PARTITIONS = {TOPIC_RAW: 6, TOPIC_VALIDATED: 6, TOPIC_DEAD_LETTER: 1}

GROUP_VALIDATOR = "validator"
GROUP_PROJECTOR = "projector"
GROUP_BACKUP = "archiver-raw"
GROUP_LAKE = "lake-parquet"
GROUP_OLAP = "olap"

# Flush limits of the two object sinks (rows, seconds).
BACKUP_MAX_ROWS, BACKUP_SECONDS = 5_000, 10
LAKE_MAX_ROWS, LAKE_SECONDS = 50_000, 60

# Dead-letter reasons, in the order in which the rules are tried.
INVALID_PREFIX = "invalid recentchange event"
MISSING_ID = f"{INVALID_PREFIX}: missing meta.id"
MISSING_TYPE = f"{INVALID_PREFIX}: missing type"
MISSING_TITLE = f"{INVALID_PREFIX}: missing title"
MISSING_WIKI = f"{INVALID_PREFIX}: missing wiki"
MISSING_USER = f"{INVALID_PREFIX}: missing user"
BAD_TIMESTAMP = f"{INVALID_PREFIX}: missing or non-positive timestamp"
DECODE_PREFIX = "event: decode"

# The detail after the prefix is this library's own wording.
DECODE_REASON = f"{DECODE_PREFIX}: payload is not one JSON object with the expected field types"

_STRING, _LONG, _BOOL = T.StringType(), T.LongType(), T.BooleanType()


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


META = struct_of(id=_STRING, domain=_STRING, stream=_STRING, dt=_STRING)
OLD_NEW = struct_of(old=_LONG, new=_LONG)

RAW_EVENT = T.StructType(
    [
        T.StructField("$schema", _STRING),
        T.StructField("meta", META),
        T.StructField("id", _LONG),
        T.StructField("type", _STRING),
        T.StructField("namespace", _LONG),
        T.StructField("title", _STRING),
        T.StructField("title_url", _STRING),
        T.StructField("comment", _STRING),
        T.StructField("timestamp", _LONG),
        T.StructField("user", _STRING),
        T.StructField("bot", _BOOL),
        T.StructField("minor", _BOOL),
        T.StructField("length", OLD_NEW),
        T.StructField("revision", OLD_NEW),
        T.StructField("server_name", _STRING),
        T.StructField("server_url", _STRING),
        T.StructField("wiki", _STRING),
    ]
)

# Structs that stay null when the payload has none; every other field gets its zero value.
OPTIONAL_STRUCTS = ("length", "revision")

ENVELOPE = struct_of(
    event_id=_STRING,
    event_type=_STRING,
    wiki=_STRING,
    title=_STRING,
    user=_STRING,
    bot=_BOOL,
    occurred_at=_LONG,
)
ENVELOPE_COLUMNS = ENVELOPE.fieldNames()

DEAD_LETTER = struct_of(
    reason=_STRING, source_topic=_STRING, partition=T.IntegerType(), offset=_LONG, raw=_STRING
)
DEAD_LETTER_COLUMNS = DEAD_LETTER.fieldNames()

# Columns of Spark's Kafka source; the file log stores the same ones.
LOG = struct_of(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=_STRING,
    partition=T.IntegerType(),
    offset=_LONG,
    timestamp=T.TimestampType(),
)
LOG_COLUMNS = LOG.fieldNames()
