"""Tool calls in conversations: linked to results, ordered, validated, written as canonical JSON.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import cut, drop_cut

#: Names of JSON types as a variant reports them.
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL.*|DOUBLE", "boolean": "BOOLEAN"}

_COLUMNS = ["conv", "turn", "level", "call_id", "status", "copies", "errors", "json"]


def argument_errors(tool: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments, as a sorted array of texts.

    A schema gives for each parameter its ``type`` (string, integer, number, boolean) and possibly
    ``required``, ``minimum``, ``maximum``, ``minLength`` and ``maxLength``. Other keys are errors.
    """
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))

    def of(schema: dict) -> Column:
        found = []
        for name, rule in schema.items():
            item = F.try_variant_get(value, f"$['{name}']", "variant")
            kind = F.coalesce(F.schema_of_variant(item), F.lit("VOID"))
            there = kind != "VOID"
            if rule.get("required"):
                found.append(F.when(~there, F.lit(f"{name}: missing")))
            fits = kind.rlike(f"^({_TYPES[rule['type']]})$")
            found.append(F.when(there & ~fits, F.lit(f"{name}: not {rule['type']}")))
            text, number = F.try_variant_get(item, "$", "string"), F.try_variant_get(item, "$", "double")
            tests = {
                "minLength": lambda x: F.length(text) < x,  # noqa: B023
                "maxLength": lambda x: F.length(text) > x,  # noqa: B023
                "minimum": lambda x: number < x,  # noqa: B023
                "maximum": lambda x: number > x,  # noqa: B023
            }
            for key, test in tests.items():
                if key in rule:
                    found.append(F.when(there & fits & test(F.lit(rule[key])), F.lit(f"{name}: {key}")))
        known = F.array(*map(F.lit, schema)) if schema else F.array().cast("array<string>")
        extra = F.array_except(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")), known)
        wrong = F.concat(F.array_compact(F.array(*found)), F.transform(extra, lambda x: F.concat(x, F.lit(": unknown"))))
        return F.when(is_object, F.array_sort(wrong)).otherwise(F.array(F.lit("arguments: not an object")))

    out = F.when(tool.isNull(), F.array(F.lit("tool: missing")))
    for name, schema in schemas.items():
        out = out.when(tool == name, of(schema))
    return out.otherwise(F.array(F.concat(F.lit("tool: unknown "), tool)))


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level, order_error) of distinct calls (conv, call_id, after).

    A call comes after the one it names, so its level is the length of the chain before it. The
    pointers along the chains are doubled each round, which takes as many rounds as the longest chain
    has binary digits. A call whose chain never ends has no level.
    """
    here = calls.select("conv", F.col("call_id").alias("up"), F.lit(True).alias("known"))
    start = calls.select("conv", "call_id", F.col("after").alias("up")).join(here, ["conv", "up"], "left")
    missing = F.col("up").isNotNull() & F.col("known").isNull()
    start = start.select(
        "conv",
        "call_id",
        F.when(~missing, F.col("up")).alias("up"),
        F.when(missing, F.lit("after: unknown")).alias("order_error"),
    )
    # steps is the distance to ``up``, or to the start of the chain where there is none.
    state = cut(start.withColumn("steps", F.col("up").isNotNull().cast("bigint")), "levels")
    rounds = calls.count().bit_length() + 1
    for _ in range(rounds):
        if state.where("up IS NOT NULL").isEmpty():
            break
        jump = state.select("conv", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        moved = state.join(jump, ["conv", "up"], "left").select(
            "conv", "call_id", F.col("next").alias("up"), "order_error", (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        moved = cut(moved, "levels")
        drop_cut(state)
        state = moved
    endless = F.col("up").isNotNull()
    return state.select(
        "conv",
        "call_id",
        F.when(~endless, F.col("steps")).alias("level"),
        F.when(endless, F.lit("after: cycle")).otherwise(F.col("order_error")).alias("order_error"),
    )


def _canonical(**fields: Column) -> Column:
    """JSON without spaces, keys in order, absent fields left out."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in sorted(fields.items())]))


def _call_json(result: Column) -> Column:
    json = lambda value: _canonical(
        arguments=value, call_id=F.col("call_id"), result=result, role=F.lit("call"), tool=F.col("tool")
    )
    plain = F.try_parse_json("arguments")
    return F.when(plain.isNull(), json(F.col("arguments"))).otherwise(json(plain))


def _further(rows: DataFrame, firsts: DataFrame, fields: list[str]) -> DataFrame:
    """Rows (conv, call_id, fields) that aren't the first of their identifier, and how many are equal.

    ``firsts`` has the first of each identifier and its copies; only identifiers with several take part.
    """
    keys = ["conv", "call_id"]
    equal = rows.groupBy(*keys, *fields).agg(F.count("*").alias("copies"))
    several = firsts.where("copies > 1").select(*keys, F.struct(*fields).alias("first"))
    own = F.col("first").eqNullSafe(F.struct(*fields))
    both = equal.join(several, keys)
    return both.withColumn("copies", F.col("copies") - own.cast("bigint")).where("copies > 0").drop("first")


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Rows (conv, turn, level, call_id, status, copies, errors, json), one per message or call.

    Input rows are (conv, turn, role, call_id, tool, arguments, after, content). Role ``call`` is a
    tool call with JSON ``arguments``, which may come ``after`` another call of its conversation;
    ``result`` answers the call with its id; every other role is a plain message. Ordered by conv,
    level and turn, calls stand in a topological order.

    status: ``linked`` (a call with its result), ``unanswered`` (a call without), ``orphan`` (a result
    without a call), ``duplicate`` or ``message``. Calls and results are joined by conversation and
    identifier. Of several calls or results with one identifier the first by turn counts, then the
    least; copies is the number of calls. Every further one is a ``duplicate``, with no level; there,
    copies is the number of equal ones, which are one row. Calls and results without a conversation or identifier link with nothing.
    errors lists what the schema, or the order, has against the call. json is canonical: keys in
    order, no spaces, nulls left out; arguments that aren't JSON stay a string. Other nulls are null
    fields, other columns are dropped, equal plain messages stay as often as they come, and empty
    tables give empty tables. A conversation may hold any share of the rows: nothing is grouped by
    conversation alone.
    """
    names = ["conv", "turn", "role", "call_id", "tool", "arguments", "after", "content"]
    rows = messages.select(*names)
    can = F.col("conv").isNotNull() & F.col("call_id").isNotNull()
    first = lambda *c: F.min(F.struct(*c)).alias("first")
    keys = ["conv", "call_id"]
    count = F.count("*").alias("copies")
    asked, answers = (rows.where((F.col("role") == role) & can) for role in ("call", "result"))
    calls = asked.groupBy(*keys).agg(first("turn", "tool", "arguments", "after"), count)
    calls = cut(calls.select(*keys, "first.*", "copies"), "calls")
    called = calls.select(*keys, F.lit(True).alias("called"))
    results = answers.groupBy(*keys).agg(first("turn", "content"), count).select(*keys, "first.*", "copies")
    answered = results.select(*keys, F.col("turn").alias("result_turn"), "content", F.lit(True).alias("answered"))
    ordered = calls.join(levels(calls.select(*keys, "after")), keys)
    linked = ordered.join(answered.hint("shuffle_hash"), keys, "left")

    loose = rows.where((F.col("role") == "call") & ~can).select(
        *keys, "turn", "tool", "arguments", "after",
        F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("level"),
        F.lit(None).cast("string").alias("order_error"), F.lit(None).cast("bigint").alias("result_turn"),
        F.lit(None).cast("string").alias("content"), F.lit(None).cast("boolean").alias("answered"),
    )
    both = linked.select(*loose.columns).union(loose)
    wrong = argument_errors(F.col("tool"), F.col("arguments"), schemas)
    done = both.select(
        "conv",
        "turn",
        "level",
        "call_id",
        F.when(F.col("answered"), F.lit("linked")).otherwise(F.lit("unanswered")).alias("status"),
        "copies",
        F.array_compact(F.concat(wrong, F.array("order_error"))).alias("errors"),
        _call_json(F.col("content")).alias("json"),
    )
    none = F.array().cast("array<string>")
    answer = _canonical(call_id=F.col("call_id"), content=F.col("content"), role=F.lit("result"))
    again = _further(asked, calls, ["turn", "tool", "arguments", "after"])
    again = again.withColumns({"errors": wrong, "json": _call_json(F.lit(None).cast("string"))})
    late = _further(answers, results, ["turn", "content"]).join(called, keys, "left_semi")
    late = late.withColumns({"errors": none, "json": answer})
    level, status = F.lit(None).cast("bigint").alias("level"), F.lit("duplicate").alias("status")
    twice = [x.select("conv", "turn", level, "call_id", status, "copies", "errors", "json") for x in (again, late)]
    orphans = rows.where(F.col("role") == "result").join(called.hint("shuffle_hash"), keys, "left_anti")
    others = rows.where(~F.coalesce(F.col("role").isin("call", "result"), F.lit(False)))
    rest = orphans.withColumn("status", F.lit("orphan")).union(others.withColumn("status", F.lit("message")).select(*orphans.columns, "status"))
    rest = rest.select(
        "conv",
        "turn",
        F.lit(0).cast("bigint").alias("level"),
        "call_id",
        "status",
        F.lit(1).cast("bigint").alias("copies"),
        none.alias("errors"),
        _canonical(call_id=F.col("call_id"), content=F.col("content"), role=F.col("role")).alias("json"),
    )
    return done.select(*_COLUMNS).union(rest.select(*_COLUMNS)).union(twice[0]).union(twice[1])
