"""Render typed rows as delivery text (the inverse of the scans).

Used to build text deliveries from tables for round-trip tests and the query
registry.  ``concat_ws`` drops NULL arguments, which would shift fields, so
each value is coalesced to the empty token first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadwright.functions.tokens import sql_ident, sql_string


def field_text(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def _field_sql(name: str) -> str:
    return f"coalesce(CAST({sql_ident(name)} AS STRING), '')"


def delimited_line(cols: list[str | Column], delimiter: str = "|") -> Column:
    if all(isinstance(c, str) for c in cols):       # plain columns: one SQL expression
        fields = ", ".join(_field_sql(c) for c in cols)
        return F.expr(f"concat_ws({sql_string(delimiter)}, {fields})")
    return F.concat_ws(delimiter, *[field_text(c) for c in cols])


def fixed_width_line(cols: list[str | Column], widths: list[int]) -> Column:
    """Each value right-padded with blanks (and cut) to its width, in characters."""
    if len(cols) != len(widths):
        raise ValueError("one width per column")
    if all(isinstance(c, str) for c in cols):
        fields = ", ".join(f"rpad({_field_sql(c)}, {int(w)}, ' ')" for c, w in zip(cols, widths))
        return F.expr(f"concat({fields})")
    return F.concat(*[F.rpad(field_text(c), int(w), " ") for c, w in zip(cols, widths)])
