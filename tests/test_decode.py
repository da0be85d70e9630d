import json

import pytest
from helpers import payload, raw_rows

from ripplelog import schema as S
from ripplelog.functions.strict_json import open_encoded
from ripplelog.operators.decode import (
    classify,
    decode_envelope,
    decode_raw,
    encode,
    flagged_envelopes,
    to_dead_letter,
    to_envelope,
    with_page_key,
)
from ripplelog.operators.routing import keyable, produced, route

GOOD = payload()

VALID = {
    "plain": GOOD,
    "white space around": f" \t\r\n{GOOD}\n ",
    "null in optional fields": payload(comment=None, length=None, revision=None, bot=None),
    "bracket in a string": payload(comment="see [[Ada]] ]} , x"),
    "unknown fields": payload(extra={"a": [1, 2.5, {"b": None}]}),
    "huge number in an unknown field": GOOD[:-1] + ',"x":1e400}',
    "repeated key, last wins": GOOD[:-1] + ',"title":"Eve"}',
    "negative namespace": payload(namespace=-1),
    "length given": payload(length={"old": 1, "new": 2}),
}

DECODE_ERROR = {
    "number for a string": payload(title=5),
    "object for a string": payload(title={}),
    "empty array for a string": payload(title=[]),
    "boolean for a string": payload(user=True),
    "string for a long": payload(timestamp="1700000000"),
    "decimal for a long": GOOD.replace("1700000000", "1700000000.0"),
    "exponent for a long": GOOD.replace("1700000000", "17e8"),
    "overflowing long": GOOD.replace("1700000000", "99999999999999999999"),
    "string for a boolean": payload(bot="true"),
    "number for a boolean": payload(bot=0),
    "array for meta": payload(meta=[]),
    "string for meta": payload(meta="x"),
    "number for meta.id": payload(meta_id=5),
    "number for meta.domain": payload(meta={"id": "a", "domain": 1}),
    "array for length": payload(length=[1]),
    "string in length": payload(length={"old": "1"}),
    "string in revision": payload(revision={"new": "1"}),
    "unused field of wrong type": payload(server_name=1),
    "trailing word": GOOD + "xyz",
    "two documents": GOOD + GOOD,
    "two documents with comma": f"{GOOD},{GOOD}",
    "closes the array wrap": GOOD + "],[1",
    "closes the array wrap, junk": GOOD + "]junk",
    "closes the array wrap, white space": GOOD + "] ",
    "closes the object wrap, junk": GOOD + "}junk",
    "closes both": GOOD + "]}",
    "second member": GOOD + ',"v":3',
    "truncated": GOOD[:-10],
    "bare truncated": '{"type":"edit","meta":{',
    "empty": "",
    "blank": "  \n",
    "array": "[1]",
    "array of the event": f"[{GOOD}]",
    "number": "5",
    "string": '"s"',
    "single quotes": "{'a':1}",
    "not a number": GOOD.replace('"bot":false', '"bot":NaN'),
    "two nulls": "null null",
    "half a null": "nul",
}

INVALID = {
    S.MISSING_ID: [payload(meta_id=""), payload(meta_id=None), payload(meta=...), "null", "{}"],
    S.MISSING_TYPE: [payload(type=""), payload(type=..., title=...)],
    S.MISSING_TITLE: [payload(title=None), payload(title="", wiki="")],
    S.MISSING_WIKI: [payload(wiki=...), payload(wiki="", user="")],
    S.MISSING_USER: [payload(user=""), payload(user="", timestamp=0)],
    S.BAD_TIMESTAMP: [payload(timestamp=0), payload(timestamp=-5), payload(timestamp=...)],
}


def test_outcome_of_every_vector(spark):
    expected = [(text, None, None) for text in VALID.values()]
    expected += [(text, S.DECODE_REASON, "decode") for text in DECODE_ERROR.values()]
    expected += [(text, reason, "invalid") for reason, texts in INVALID.items() for text in texts]
    rows = classify(raw_rows(spark, [text for text, _, _ in expected]))
    got = {r.offset: (r.reason, r.error_class) for r in rows.select("offset", "reason", "error_class").collect()}
    names = [*VALID, *DECODE_ERROR]
    for number, (text, reason, kind) in enumerate(expected):
        label = names[number] if number < len(names) else text
        assert got[number] == (reason, kind), label
    # The same verdict when a filter uses it.
    valid = classify(raw_rows(spark, [t for t, _, _ in expected])).where("reason IS NULL").count()
    assert valid == len(VALID)


def test_valid_and_dead_add_up(spark):
    texts = [*VALID.values(), *DECODE_ERROR.values()]
    rows = classify(raw_rows(spark, texts))
    assert to_envelope(rows).count() + to_dead_letter(rows).count() == len(texts)


def test_typed_event(spark):
    texts = [
        payload(),
        payload(minor=True, length={"old": 1, "new": 2}, revision={"new": 9}),
        "nope",
    ]
    plain, full, bad = decode_raw(raw_rows(spark, texts)).orderBy("offset").collect()
    assert plain.decode_ok and plain.event["$schema"] == "/mediawiki/recentchange/1.0.0"
    assert plain.event.length is None and plain.event.revision is None
    assert plain.event.minor is False and plain.event.title_url == ""
    assert plain.event.meta.id == "e-1" and plain.event.timestamp == 1_700_000_000
    assert full.event.minor is True and full.event.length == (1, 2)
    assert full.event.revision == (0, 9)
    assert bad.decode_ok is False and bad.event is None


def test_page_key(spark):
    texts = [
        '{"wiki":"enwiki","title":"Ada","extra":1}',
        '{"wiki":"enwiki"}',
        '{"title":"Ada"}',
        '{"wiki":"","title":"Ada"}',
        '{"wiki":5,"title":"Ada"}',
        '{"wiki":',
        '{"wiki":"enwiki","title":"Ada"}x',
        "null",
        '{"wiki":"enwiki","title":"Ada","timestamp":"not checked here"}',
    ]
    keys = [r.page_key for r in with_page_key(raw_rows(spark, texts)).orderBy("offset").collect()]
    assert keys == ["enwiki:Ada", *[None] * 7, "enwiki:Ada"]


def test_producer_skips_what_it_cannot_key(spark):
    texts = ['{"wiki":"enwiki","title":"A"}', '{"wiki":"dewiki","title":"B"}', '{"type":"log"}']
    rows = spark.createDataFrame([(text,) for text in texts], "payload string")
    assert keyable(rows, "payload").count() == 2
    messages = {bytes(r.key).decode(): bytes(r.value).decode() for r in produced(rows).collect()}
    assert messages == {"enwiki:A": texts[0], "dewiki:B": texts[1]}


def test_envelope_and_dead_letter_fields(spark):
    rows = classify(raw_rows(spark, [payload(bot=True, user="alice"), payload(meta_id="")]))
    assert tuple(to_envelope(rows).collect()[0]) == (
        "e-1",
        "edit",
        "enwiki",
        "Ada",
        "alice",
        True,
        1_700_000_000,
    )
    letter = to_dead_letter(rows).collect()[0]
    assert tuple(letter) == (S.MISSING_ID, S.TOPIC_RAW, 0, 1, payload(meta_id=""))


def test_route_gives_one_json_message_per_row(spark):
    log = raw_rows(spark, [payload(title='q"<&>\n'), "broken"])
    valid, dead = route(log).orderBy("source_offset").collect()
    assert (valid.topic, dead.topic) == (S.TOPIC_VALIDATED, S.TOPIC_DEAD_LETTER)
    assert bytes(valid.key) == bytes(dead.key) == b"k"
    assert list(json.loads(bytes(valid.value))) == S.ENVELOPE_COLUMNS
    assert json.loads(bytes(valid.value))["title"] == 'q"<&>\n'
    assert json.loads(bytes(dead.value)) == {
        "reason": S.DECODE_REASON,
        "source_topic": S.TOPIC_RAW,
        "partition": 0,
        "offset": 1,
        "raw": "broken",
    }


def test_envelope_survives_encoding(spark):
    envelopes = to_envelope(classify(raw_rows(spark, [payload(user="ü, \"x\"")])), "offset")
    encoded = envelopes.select("offset", encode(*S.ENVELOPE_COLUMNS).cast("binary").alias("value"))
    assert decode_envelope(encoded, "offset").collect() == envelopes.collect()


def test_broken_envelope_fails_the_job(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        decode_envelope(raw_rows(spark, ['{"event_id":'])).collect()


def test_parse_runs_once_below_the_filter(spark):
    rows = to_envelope(classify(raw_rows(spark, [GOOD])))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


ENVELOPE = '{"event_id":"k","event_type":"edit","wiki":"w","title":"t","user":"u","bot":true,"occurred_at":5}'


@pytest.mark.parametrize(
    "text", [ENVELOPE + "x", ENVELOPE * 2, f"{ENVELOPE},{ENVELOPE}", "", "[]", "5", "x", '{"title":5}', '{"user":{}}', '{"bot":"true"}', '{"occurred_at":5.0}']
)
def test_any_other_envelope_fails_the_job(spark, text):
    with pytest.raises(Exception, match="malformed envelope"):
        decode_envelope(raw_rows(spark, [ENVELOPE, text]), "offset").count()


def test_absent_envelope_fields_have_zero_values(spark):
    rows = decode_envelope(raw_rows(spark, [ENVELOPE, "{}", '{"bot":null,"more":1}']), "offset")
    zero = ("", "", "", "", "", False, 0)
    assert [tuple(r) for r in rows.orderBy("offset").collect()] == [(0, "k", "edit", "w", "t", "u", True, 5), (1, *zero), (2, *zero)]


def _envelope(**values):
    """Text of an envelope with other values for some fields."""
    return json.dumps(json.loads(ENVELOPE) | values, separators=(",", ":"), ensure_ascii=False)


ENCODED = {
    ENVELOPE: ("k", "edit", "w", "t", "u", True, 5),
    _envelope(title="ü \U0001f600 \ufffd ]},'", occurred_at=-7): ("k", "edit", "w", "ü \U0001f600 \ufffd ]},'", "u", True, -7),
    _envelope(event_id="", bot=False, occurred_at=2**63 - 1): ("", "edit", "w", "t", "u", False, 2**63 - 1),
    _envelope(bot=None, occurred_at=None): ("k", "edit", "w", "t", "u", False, 0),
}

OTHER = {
    _envelope(title='a "b" \\ \n'): ("k", "edit", "w", 'a "b" \\ \n', "u", True, 5),
    _envelope(title=None): ("k", "edit", "w", "", "u", True, 5),
    _envelope(title=',"bot":false'): ("k", "edit", "w", ',"bot":false', "u", True, 5),
    ENVELOPE.replace('"t"', '"\\u0074"'): ("k", "edit", "w", "t", "u", True, 5),
    f" {ENVELOPE}": ("k", "edit", "w", "t", "u", True, 5),
    ENVELOPE.replace(":5}", ":5 }"): ("k", "edit", "w", "t", "u", True, 5),
    ENVELOPE.replace(":5}", ":5,\"more\":[1]}"): ("k", "edit", "w", "t", "u", True, 5),
    ENVELOPE.replace(":5}", ":5,\"bot\":false}"): ("k", "edit", "w", "t", "u", False, 5),
    _envelope(title="x" * 1_000_000): ("k", "edit", "w", "x" * 1_000_000, "u", True, 5),
    ENVELOPE.replace(":5}", ":05}"): None,
    ENVELOPE.replace(":5}", ':"5"}'): None,
    ENVELOPE.replace("true", "1"): None,
    ENVELOPE.replace('"t"', "7"): None,
    ENVELOPE.replace('"t"', '"a\tb"'): None,
    ENVELOPE + "}": None,
    ENVELOPE[:-1]: None,
    "null": ("", "", "", "", "", False, 0),
    '""': None,
    "": None,
}


def test_only_what_encode_writes_is_read_without_the_strict_decode(spark):
    vectors = ENCODED | OTHER
    rows = open_encoded(raw_rows(spark, list(vectors)), "value", S.ENVELOPE).orderBy("offset").collect()
    assert [r._same for r in rows] == [text in ENCODED for text in vectors]
    assert [r._odd for r in rows] == [None if text in ENCODED else text.encode() for text in vectors]
    decoded = flagged_envelopes(raw_rows(spark, list(vectors)), S.ENVELOPE, "offset").orderBy("offset").collect()
    assert [None if r._broken else tuple(r)[1:-1] for r in decoded] == list(vectors.values())


def test_bytes_that_are_no_text_are_not_read_as_encoded(spark):
    bad = ENVELOPE.encode().replace(b'"t"', b'"a\xffb"')
    rows = spark.createDataFrame([(bad,)], "value binary")
    assert open_encoded(rows, "value", S.ENVELOPE).first()._odd == bad
    assert flagged_envelopes(rows, S.ENVELOPE).first().title == "a\ufffdb"


def test_known_deviations_of_repeated_keys_and_parser_limits(spark):
    """The last copy of a repeated key decides alone, and the parser has limits for unknown fields."""
    vectors = {
        GOOD[:-1] + ',"user":5,"user":"x"}': None,
        GOOD[:-1] + ',"title":null}': S.MISSING_TITLE,
        GOOD[:-1] + ',"meta":{"stream":"s"}}': S.MISSING_ID,
        GOOD[:-1] + ',"x":' + "[" * 1500 + "]" * 1500 + "}": S.DECODE_REASON,
        GOOD[:-1] + ',"x":' + "9" * 1200 + "}": S.DECODE_REASON,
    }
    rows = classify(raw_rows(spark, list(vectors))).orderBy("offset").collect()
    assert [r.reason for r in rows] == list(vectors.values())
