"""Projections, custom SQL steps, row filters and column choice.

Fixed values that must equal the reference:
  - audit columns ``METADATA_TM_FILE`` (file date) and ``METADATA_TM_INSERT``
    (load time) come first in the target, both second-precision timestamps
  - custom SQL may name the schema and the stage table as ``[SCHEMA]`` and
    ``[TABLE]``
  - the class label of a modelling table defaults to column position 5 (0-based)
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.names import file_date_sql
from loadwright.functions.tokens import sql_ident, sql_string

AUDIT_FILE = "METADATA_TM_FILE"
AUDIT_INSERT = "METADATA_TM_INSERT"
AUDIT_COLUMNS = (AUDIT_FILE, AUDIT_INSERT)
DEFAULT_LABEL_POSITION = 5


def seconds_sql(ts: str) -> str:
    """A TIMESTAMP_NTZ literal (SQL text) cut to whole seconds (no session time zone involved)."""
    value = datetime.fromisoformat(ts).replace(microsecond=0, tzinfo=None)
    return f"TIMESTAMP_NTZ '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def stamp_audit(df: DataFrame, file_date: str, run_ts: str) -> DataFrame:
    """Prefix the two audit columns; ``file_date`` is ``yyyyMMdd-HHmmss``.

    Both are constants of the run, so the projection is one ``selectExpr``
    that Catalyst folds to two literals.
    """
    data = [c for c in df.columns if c not in AUDIT_COLUMNS]
    return df.selectExpr(
        f"{file_date_sql(sql_string(file_date))} AS {AUDIT_FILE}",
        f"{seconds_sql(run_ts)} AS {AUDIT_INSERT}",
        *[sql_ident(c) for c in data],
    )


def project(stage: DataFrame, exprs: list[str] | str | None = None) -> DataFrame:
    """Stage -> target projection: all columns, or SQL expressions.

    Audit columns, when present, are always carried first.
    """
    if not exprs or exprs == "*":
        return stage
    if isinstance(exprs, str):
        exprs = [exprs]
    audit = [c for c in AUDIT_COLUMNS if c in stage.columns]
    return stage.selectExpr(*audit, *exprs)


def apply_steps(spark: SparkSession, stage: DataFrame, steps: list[str],
                schema_name: str = "stage") -> DataFrame:
    """Run ordered SELECT statements, each over the result of the one before.

    A step names its input ``{stage}`` (or ``[SCHEMA].[TABLE]`` / ``[TABLE]`` as in
    the original property files).  Each step is a query, not an UPDATE/DELETE:
    Spark refuses DML on a passed DataFrame, so edits are written as SELECTs.
    """
    current = stage
    for sql in steps:
        text = (sql.replace("[SCHEMA].[TABLE]", "{stage}")
                .replace("[TABLE]", "{stage}")
                .replace("[SCHEMA].", ""))
        current = spark.sql(text, stage=current)
    return current


def where_equal(df: DataFrame, col: str | None = None, value=None) -> DataFrame:
    """Equality filter used by the counts (no filter when ``col`` is None)."""
    if col is None:
        return df
    return df.where(F.col(col) == F.lit(value))


def choose(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns in the user's order."""
    return df.select(*cols)


def column_at(df: DataFrame, position: int = DEFAULT_LABEL_POSITION) -> str:
    """Name of the column at a 0-based position."""
    return df.columns[position]


def split_target(df: DataFrame, cols: list[str], label: str | int | None = DEFAULT_LABEL_POSITION):
    """First chosen column is the target, the rest are predictors.

    Returns ``(frame, target, predictors, label)`` where ``frame`` holds the
    chosen columns plus the label column (by name or position).
    """
    if len(cols) < 2:
        raise ValueError("choose a target and at least one predictor")
    target, predictors = cols[0], list(cols[1:])
    label_name = None
    if label is not None:
        label_name = column_at(df, label) if isinstance(label, int) else label
    extra = [label_name] if label_name and label_name not in cols else []
    return df.select(*cols, *extra), target, predictors, label_name


def first_rows(df: DataFrame, n: int, order: list[str] | str) -> DataFrame:
    """Preview: the first ``n`` rows in a stated order (a top-n, never a full collect)."""
    order = [order] if isinstance(order, str) else order
    return df.orderBy(*order).limit(int(n))
