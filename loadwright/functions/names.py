"""Delivery file names: dot-separated metadata fields.

Fixed values that must equal the reference for the same file names to mean
the same thing:
  - fields are separated by ``.``
  - field 7 (1-based) is the load mode, field 10 the file date
  - the file date is written ``yyyyMMdd-HHmmss``
  - the modes that are applied are ``FULL`` and ``UPDT``; a ``UPDT`` without
    a key list is applied as ``INST``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_SEPARATOR = "."
MODE_FIELD = 7
DATE_FIELD = 10
FILE_DATE_FORMAT = "yyyyMMdd-HHmmss"
MODE_FULL = "FULL"
MODE_UPDATE = "UPDT"
MODE_INSERT = "INST"


def base_name(path: Column) -> Column:
    """Last path component; dots in folder names cannot shift the fields."""
    return F.element_at(F.split(path, "/"), -1)


def name_field(file_name: Column, position: int) -> Column:
    """1-based dot field of a file name; NULL when the name is shorter."""
    return F.get(F.split(file_name, "\\."), position - 1)


def file_date_sql(text: str) -> str:
    """SQL text turning ``20200310-000000`` into TIMESTAMP_NTZ ``2020-03-10 00:00:00``.

    ``text`` is a SQL expression (a quoted column or a literal).  Malformed
    text gives NULL.  The value is built from the digits with
    ``try_make_timestamp_ntz`` so that no session time zone is involved (a
    zone's daylight-saving gap cannot move the time); on a literal Catalyst
    folds the whole expression to a constant.
    """
    parts = ", ".join(f"try_cast(substring({text}, {pos}, {n}) AS INT)"
                      for pos, n in ((1, 4), (5, 2), (7, 2), (10, 2), (12, 2)))
    sec = f"try_cast(substring({text}, 14, 2) AS DECIMAL(16,6))"
    return (f"CASE WHEN {text} RLIKE '^[0-9]{{8}}-[0-9]{{6}}$' "
            f"THEN try_make_timestamp_ntz({parts}, {sec}) END")


def file_date_ts(column: str) -> Column:
    """The file date in column ``column`` as TIMESTAMP_NTZ (see :func:`file_date_sql`)."""
    return F.expr(file_date_sql("`" + column.replace("`", "``") + "`"))
