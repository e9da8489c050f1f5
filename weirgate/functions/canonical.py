"""Canonical JSON, as a value on the driver and as a column expression.

Keys sorted by code point, no blanks, every key present; only the quote, the
backslash and control characters are escaped; decimals are fixed-point strings
with their scale, dates ISO strings, timestamps UTC with six digits.  Floats have
no canonical form and are refused.
"""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Control characters with a short escape.
SHORT = {"\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
ESCAPES = {"\\": "\\\\", '"': '\\"', **{chr(i): SHORT.get(chr(i), f"\\u{i:04x}") for i in range(32)}}


def _quoted(text: str) -> str:
    return '"' + "".join(ESCAPES.get(c, c) for c in text) + '"'


def canonical_text(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, str):
        return _quoted(value)
    if isinstance(value, Decimal):
        if not value.is_finite():
            raise ValueError("a decimal that is not finite has no canonical form")
        return _quoted(format(value, "f"))
    if isinstance(value, datetime.datetime):
        if value.tzinfo is None:
            raise ValueError("a timestamp without a zone has no canonical form")
        return _quoted(value.astimezone(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"))
    if isinstance(value, datetime.date):
        return _quoted(value.isoformat())
    if isinstance(value, dict):
        if any(not isinstance(k, str) for k in value):
            raise ValueError("keys are strings")
        return "{" + ",".join(f"{_quoted(k)}:{canonical_text(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical_text, value)) + "]"
    raise ValueError(f"{type(value).__name__} has no canonical form")


_ODD = "[\\x00-\\x1f\"\\\\]"


def quoted(text: Column) -> Column:
    """A JSON string; texts without a character to escape skip the replacements."""
    out = text
    for plain, escaped in ESCAPES.items():
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), F.when(text.rlike(_ODD), out).otherwise(text), F.lit('"'))


def canonical(value: Column, kind: T.DataType) -> Column:
    """The canonical JSON of a column of the given type; null gives ``null``."""
    if isinstance(kind, T.StringType):
        out = quoted(value)
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        out = value.cast("string")
    elif isinstance(kind, T.DecimalType):
        shape = "0." + "0" * kind.scale if kind.scale else "0"
        out = F.concat(F.lit('"'), F.call_function("format_number", value, F.lit(shape)), F.lit('"'))
    elif isinstance(kind, T.DateType):
        out = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    elif isinstance(kind, T.TimestampType):
        out = F.concat(F.lit('"'), F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('"'))
    elif isinstance(kind, T.NullType):
        return F.lit("null")
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("keys are strings")
        entries = F.array_sort(F.map_keys(value))
        out = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda k: F.concat(quoted(k), F.lit(":"), canonical(F.element_at(value, k), kind.valueType))), ","), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StructType):
        return F.when(value.isNull(), F.lit("null")).otherwise(canonical_object({f.name: (value[f.name], f.dataType) for f in kind.fields}))
    else:
        raise ValueError(f"{kind.simpleString()} has no canonical form")
    return F.coalesce(out, F.lit("null"))


def canonical_object(fields: dict[str, tuple[Column, T.DataType]]) -> Column:
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        value, kind = fields[name]
        parts += [F.lit(("," if i else "{") + _quoted(name) + ":"), canonical(value, kind)]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def row_snapshot(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The canonical JSON object of the named columns (all by default)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return canonical_object({c: (F.col(f"`{c}`"), types[c]) for c in columns or df.columns})


def row_hash(snapshot: Column) -> Column:
    return F.sha2(snapshot, 256)
