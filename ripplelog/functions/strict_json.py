"""Strict JSON decoding built from Spark's variant expressions.

``from_json`` turns numbers into strings and ignores text after the first value. Here a payload
decodes only if it is exactly one JSON value and every known field has its declared type.

The payload is parsed once, as ``[payload]``. Spark ignores what follows the value it parsed, so
this alone accepts ``x]junk`` and ``x,y``. A second element shows the comma. A payload without
``]`` cannot have closed the array early; for one that has the character, ``{"v":payload}`` is
tokenized as well, which tolerates only ``}`` or ``,`` after the value. Passing both wraps leaves
exactly one value.

Expressions are SQL text: each is one call into the JVM instead of one per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VARIANT_NAMES = {
    T.StringType: "STRING",
    T.LongType: "BIGINT",
    T.BooleanType: "BOOLEAN",
}

_ZERO = {T.StringType: "''", T.LongType: "0L", T.BooleanType: "false"}

# Bytes from which on a payload is left to the strict decode.
_LONG = 1_000_000

_SPACE = r"' \t\r\n'"


def _shape(schema: T.StructType) -> str:
    return "struct<" + ",".join(f"`{name}`:variant" for name in schema.fieldNames()) + ">"


def _nested(schema: T.StructType) -> list[T.StructField]:
    return [field for field in schema if isinstance(field.dataType, T.StructType)]


def open_document(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """Add ``_single``, ``_root`` and one ``_in_<name>`` per nested struct.

    The projections stay apart, since Spark does not merge one into the next when that would
    repeat an expensive expression. So the payload is parsed once per row.
    """
    text = f"CAST(`{payload}` AS string)"
    parsed = df.withColumn("_array", F.expr(f"try_parse_json('[' || {text} || ']')"))
    rooted = parsed.withColumns(
        {
            "_single": F.expr(
                f"""_array IS NOT NULL AND try_variant_get(_array, '$[1]', 'variant') IS NULL
                AND (NOT contains({text}, ']')
                     OR json_object_keys('{{"v":' || {text} || '}}') IS NOT NULL)"""
            ),
            "_root": F.expr(f"try_variant_get(_array, '$[0]', '{_shape(schema)}')"),
            "_null_document": F.expr(f"trim(BOTH {_SPACE} FROM {text}) = 'null'"),
        }
    ).drop("_array")
    inner = {
        f"_in_{part.name}": F.expr(
            f"try_variant_get(_root.`{part.name}`, '$', '{_shape(part.dataType)}')"
        )
        for part in _nested(schema)
    }
    return rooted.withColumns(inner) if inner else rooted


def open_encoded(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """Add ``_plain``, the payload cut at its quotation marks and read as if ``to_json`` had written it;
    ``_same``, whether ``to_json`` makes the same text of that; and ``_odd``, the payload if not.

    What is read and encodes to the same text once more is exactly one object with the fields of a flat
    ``schema``, whoever wrote it. Anything else (other fields, order or white space, a number for a
    string, an escaped character, text after the object) makes another text. Long payloads are left to
    the strict decode, which has a limit of its own.
    """
    text = f"CAST(`{payload}` AS string)"
    members, at = [], 1  # where the name of a field stands among the pieces
    for part in schema:
        if isinstance(part.dataType, T.StringType):
            value, at = f"get(_cut, {at + 2})", at + 4
        else:
            piece, at = f"get(_cut, {at + 1})", at + 2
            value = f"try_cast(substr({piece}, 2, length({piece}) - 2) AS {part.dataType.simpleString()})"
        members.append(F.expr(value).alias(part.name))
    cut = df.withColumn("_cut", F.expr(f"CASE WHEN octet_length({text}) < {_LONG} THEN split({text}, '\"') END"))
    read = cut.withColumn("_plain", F.struct(*members)).drop("_cut")
    written = "to_json(_plain, map('ignoreNullFields', 'false'))"
    same = read.withColumn("_same", F.expr(f"coalesce({written} = {text}, false)"))
    return same.withColumn("_odd", F.expr(f"CASE WHEN NOT _same THEN `{payload}` END"))


def encoded_field(schema: T.StructType, name: str) -> str:
    """One scalar of ``_plain``, with its zero value when null."""
    return f"coalesce(_plain.`{name}`, {_ZERO[type(schema[name].dataType)]})"


def close_document(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Drop the helper columns of :func:`open_document`."""
    helpers = ["_single", "_root", "_null_document"]
    return df.drop(*helpers, *[f"_in_{part.name}" for part in _nested(schema)])


def pinned(verdict: str) -> str:
    """A verdict expression that filters cannot be pushed below.

    Spark moves a filter under the projections that compute its columns and copies their
    expressions into it: every parse would then run once more in the filter, nested into each of
    the type checks. It leaves the filter above a projection that has a non-deterministic field,
    and the partition number counts as one. The value of the verdict does not depend on it.
    """
    return f"CASE WHEN spark_partition_id() >= 0 THEN {verdict} END"


def _all_of(values: list[str], name: str) -> str:
    """Whether every value that is there is JSON null or has the named type.

    The type names are joined and the allowed ones cut out, which leaves nothing exactly when no
    other name was among them. One expression for many fields keeps the generated code small
    enough for the JVM to compile.
    """
    found = ", ".join(f"schema_of_variant({value})" for value in values)
    return f"replace(replace(concat_ws('', {found}), '{name}', ''), 'VOID', '') = ''"


def decodes(schema: T.StructType) -> str:
    """Whether an opened document is one value with well-typed fields; null counts as empty."""
    by_type: dict[str, list[str]] = {}
    checks = ["_single", "(_root IS NOT NULL OR _null_document)"]
    for part in schema:
        value = f"_root.`{part.name}`"
        if isinstance(part.dataType, T.StructType):
            inner = f"_in_{part.name}"
            checks.append(f"({value} IS NULL OR {inner} IS NOT NULL OR is_variant_null({value}))")
            scalars = [(f"{inner}.`{sub.name}`", sub.dataType) for sub in part.dataType]
        else:
            scalars = [(value, part.dataType)]
        for scalar, kind in scalars:
            by_type.setdefault(_VARIANT_NAMES[type(kind)], []).append(scalar)
    checks += [_all_of(values, name) for name, values in by_type.items()]
    return "(" + " AND ".join(checks) + ")"


def field(schema: T.StructType, path: str) -> str:
    """One decoded scalar of an opened document, with its zero value when absent."""
    outer, _, name = path.partition(".")
    kind = schema[outer].dataType[name].dataType if name else schema[outer].dataType
    value = f"_in_{outer}.`{name}`" if name else f"_root.`{outer}`"
    typed = f"try_variant_get({value}, '$', '{kind.simpleString()}')"
    return f"coalesce({typed}, {_ZERO[type(kind)]})"


def document(schema: T.StructType, optional: tuple[str, ...] = ()) -> str:
    """The whole typed struct of an opened document; ``optional`` structs stay null when absent."""
    members = []
    for part in schema:
        if isinstance(part.dataType, T.StructType):
            inner = ", ".join(
                f"'{sub.name}', {field(schema, f'{part.name}.{sub.name}')}" for sub in part.dataType
            )
            value = f"named_struct({inner})"
            if part.name in optional:
                value = f"CASE WHEN _in_{part.name} IS NOT NULL THEN {value} END"
        else:
            value = field(schema, part.name)
        members.append(f"'{part.name}', {value}")
    return f"named_struct({', '.join(members)})"
