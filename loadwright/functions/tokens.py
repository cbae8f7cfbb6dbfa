"""Column expressions that cut text lines into typed fields.

Everything here is a JVM expression (``Column`` objects or SQL text), so
the work stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType, VarcharType

from pyspark.sql.types import _parse_datatype_string


def as_struct(schema: str | StructType) -> StructType:
    """Accept a DDL string (``"id BIGINT, name STRING"``) or a StructType."""
    if isinstance(schema, StructType):
        return schema
    parsed = _parse_datatype_string(schema)
    if not isinstance(parsed, StructType):
        raise ValueError(f"schema must describe columns, got {schema!r}")
    return parsed


_JAVA_REGEX_META = set(".$|()[]{}^?*+\\")


def java_regex_literal(text: str) -> str:
    """A Java regex that matches ``text`` literally (``split`` takes a regex).

    A single character is written bare or as ``\\c``: Java's ``String.split``
    then splits without the regex engine.  Longer delimiters are quoted.
    """
    if not text:
        raise ValueError("delimiter must not be empty")
    if len(text) == 1 and not text.isalnum():
        return "\\" + text if text in _JAVA_REGEX_META else text
    if len(text) == 1:
        return text
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_fields(line: Column, delimiter: str) -> Column:
    """All fields of a delimited line; trailing empty fields are kept (limit -1)."""
    return F.split(line, java_regex_literal(delimiter), -1)


def sql_ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A SQL string literal holding ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The helpers below return SQL text, not Column objects: a parse builds a few
# expressions per declared field, and one ``selectExpr`` of text costs one call
# into the JVM where the same Column objects cost hundreds.

def null_if_empty(token: str) -> str:
    """Empty token -> NULL (delimited NULL rule)."""
    return f"nullif({token}, '')"


def null_if_blank(token: str) -> str:
    """Right-trimmed token, NULL when nothing but blanks (fixed-width NULL rule)."""
    return f"nullif(rtrim({token}), '')"


def typed(token: str, dtype: DataType, mask: str | None = None) -> str:
    """Cast a NULL-normalised token; NULL when the text does not convert.

    ``mask`` is a Spark datetime pattern (``yyyyMMdd``) for a date or time column.
    """
    if mask is not None:
        return _masked(token, dtype, mask)
    if isinstance(dtype, (StringType, CharType, VarcharType)):
        return token  # an over-long text is a reject of its own, never cut
    return f"try_cast({token} AS {dtype.simpleString()})"


def _masked(token: str, dtype: DataType, mask: str) -> str:
    if isinstance(dtype, DateType):
        return f"try_to_date({token}, {sql_string(mask)})"
    if isinstance(dtype, TimestampType):
        return f"try_to_timestamp({token}, {sql_string(mask)})"
    if isinstance(dtype, TimestampNTZType):  # read as UTC and counted from 1970, so no session zone moves it
        at = f"try_to_timestamp({token} || ' +0000', {sql_string(mask + ' xx')})"
        seconds = f"CAST(unix_micros({at}) AS DECIMAL(20, 0)) / 1000000"
        return f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    raise ValueError(f"a mask needs a date or time column, not {dtype.simpleString()}")


def cast_failed(token: str, value: str) -> str:
    """True when a present token produced no value (the reject rule)."""
    return f"({token} IS NOT NULL AND {value} IS NULL)"


def fixed_width_starts(widths: list[int]) -> list[int]:
    """1-based start position of each field (``substring`` counts characters)."""
    if not widths or any(int(w) <= 0 for w in widths):
        raise ValueError(f"widths must be positive, got {widths!r}")
    starts, pos = [], 1
    for w in widths:
        starts.append(pos)
        pos += int(w)
    return starts


def parse_widths(spec: str | list[int]) -> list[int]:
    """``"8,24,10"`` or ``"8|24|10"`` or a list -> list of ints."""
    if isinstance(spec, (list, tuple)):
        return [int(w) for w in spec]
    return [int(w) for w in re.split(r"[,|\s]+", spec.strip()) if w]
