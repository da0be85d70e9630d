"""Raw payload to typed event, envelope and dead letter, and back to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog import schema as S
from ripplelog.functions import strict_json as J
from ripplelog.functions.keys import join_key
from ripplelog.session import configured

_KEY_FIELDS = S.T.StructType([S.RAW_EVENT["wiki"], S.RAW_EVENT["title"]])


def text(value: Column) -> Column:
    return value.cast("string")


def with_page_key(df: DataFrame, payload: str = "value", name: str = "page_key") -> DataFrame:
    """Add the page key decoded from two fields only; null when the payload has no key."""
    opened = J.open_document(configured(df), payload, _KEY_FIELDS)
    parts = opened.withColumns(
        {
            "_key_ok": F.expr(J.decodes(_KEY_FIELDS)),
            "_wiki": F.expr(J.field(_KEY_FIELDS, "wiki")),
            "_title": F.expr(J.field(_KEY_FIELDS, "title")),
        }
    )
    key = join_key(F.col("_wiki"), F.col("_title"))
    keyed = J.close_document(parts, _KEY_FIELDS).withColumn("_key", F.when(F.col("_key_ok"), key))
    return keyed.withColumn(name, F.expr(J.pinned("_key"))).drop("_key_ok", "_wiki", "_title", "_key")


def decode_raw(df: DataFrame, payload: str = "value") -> DataFrame:
    """Add the typed struct ``event`` and ``decode_ok``; ``event`` is null when decoding fails."""
    opened = J.open_document(configured(df), payload, S.RAW_EVENT)
    judged = opened.withColumn("decode_ok", F.expr(J.pinned(J.decodes(S.RAW_EVENT))))
    event = f"CASE WHEN decode_ok THEN {J.document(S.RAW_EVENT, S.OPTIONAL_STRUCTS)} END"
    return J.close_document(judged.withColumn("event", F.expr(event)), S.RAW_EVENT)


# Envelope column and where its value stands in the payload.
_ENVELOPE_PATHS = {
    "event_id": "meta.id",
    "event_type": "type",
    "wiki": "wiki",
    "title": "title",
    "user": "user",
    "bot": "bot",
    "occurred_at": "timestamp",
}


def _reason() -> str:
    """First failing rule over decoded envelope columns, or null for a valid event."""
    rules = [
        ("NOT _decode_ok", S.DECODE_REASON),
        ("event_id = ''", S.MISSING_ID),
        ("event_type = ''", S.MISSING_TYPE),
        ("title = ''", S.MISSING_TITLE),
        ("wiki = ''", S.MISSING_WIKI),
        ("`user` = ''", S.MISSING_USER),
        ("occurred_at <= 0", S.BAD_TIMESTAMP),
    ]
    return "CASE " + " ".join(f"WHEN {failed} THEN '{text}'" for failed, text in rules) + " END"


def classify(df: DataFrame, payload: str = "value") -> DataFrame:
    """Add the envelope columns, ``reason`` and ``error_class``.

    ``reason`` is null exactly for valid events. Only the envelope fields are extracted; the
    other fields are type-checked, since one wrong type rejects the whole payload.
    """
    opened = J.open_document(configured(df), payload, S.RAW_EVENT)
    typed = opened.withColumns(
        {name: F.expr(J.field(S.RAW_EVENT, path)) for name, path in _ENVELOPE_PATHS.items()}
        | {"_decode_ok": F.expr(J.decodes(S.RAW_EVENT))}
    )
    judged = J.close_document(typed, S.RAW_EVENT).withColumn("reason", F.expr(J.pinned(_reason())))
    kind = "CASE WHEN reason IS NOT NULL THEN if(_decode_ok, 'invalid', 'decode') END"
    return judged.withColumn("error_class", F.expr(kind)).drop("_decode_ok")


def to_envelope(classified: DataFrame, *keep: str) -> DataFrame:
    """Envelopes of the valid events, with the named source columns kept beside them."""
    return classified.where(F.col("reason").isNull()).select(*keep, *S.ENVELOPE_COLUMNS)


def dead_letter_fields(payload: str = "value") -> list[Column]:
    """Reason, source coordinates and payload of a classified log row."""
    return [
        F.col("reason"),
        F.col("topic").alias("source_topic"),
        F.col("partition"),
        F.col("offset"),
        text(F.col(payload)).alias("raw"),
    ]


def to_dead_letter(classified: DataFrame, payload: str = "value") -> DataFrame:
    """Dead letters of the rejected log rows."""
    return classified.where(F.col("reason").isNotNull()).select(*dead_letter_fields(payload))


def encode(*fields: Column | str) -> Column:
    """Fields as one JSON object; every field is written, null or not."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def decode_envelope(df: DataFrame, *keep: str, payload: str = "value") -> DataFrame:
    """Envelope columns of validated log rows; an absent field has its zero value. A row that is not
    exactly one JSON object with the expected types fails the job: such a row is a bug upstream,
    not bad input."""
    decoded = flagged_envelopes(df, S.ENVELOPE, *keep, payload=payload)
    failed = "raise_error('malformed envelope on the validated topic')"
    return decoded.where(F.expr(f"CASE WHEN _broken THEN {failed} ELSE true END")).drop("_broken")


def flagged_envelopes(
    df: DataFrame, fields: S.T.StructType, *keep: str, payload: str = "value"
) -> DataFrame:
    """Flat JSON objects as columns, with ``_broken`` for values that do not decode strictly.

    Most values are what :func:`encode` wrote. One that encodes to the same text once more is exactly
    one object with the declared fields, so only the others go through the strict decode.
    """
    plain = J.open_encoded(configured(df), payload, fields)
    opened = J.open_document(plain, "_odd", fields)
    typed = opened.withColumns(
        {f"_f_{f.name}": F.expr(f"CASE WHEN _same THEN {J.encoded_field(fields, f.name)} ELSE {J.field(fields, f.name)} END") for f in fields}
        | {"_ok": F.expr(f"_same OR coalesce({J.decodes(fields)}, false)")}
    )
    judged = J.close_document(typed, fields).withColumn("_broken", F.expr(J.pinned("NOT _ok")))
    return judged.select(*keep, *[F.col(f"_f_{f.name}").alias(f.name) for f in fields], "_broken")
