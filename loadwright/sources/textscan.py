"""Scans of text deliveries: delimited and fixed-width lines -> typed rows.

A parsed frame keeps every input line and classifies it:

  ``_status``  ``good`` | ``rejected`` | ``discarded``
  ``_reason``  why a line was rejected (NULL otherwise)
  ``_line``    the whole original line

Rules (one semantics for both database dialects of the original tool):
  - an empty delimited field is NULL; an all-blank fixed-width field is NULL
  - quotes and backslashes are ordinary characters
  - a line with more fields than declared is rejected
  - a line with fewer fields is padded with NULLs (``pad_short_rows``) or rejected
  - a present token that does not convert to its declared type is rejected;
    ``formats`` (column: Spark datetime pattern) says how a date or time is written
  - a blank line is discarded

The CSV reader is not used: in PERMISSIVE mode it puts short rows into the
corrupt-record column and it interprets quotes, which contradicts the rules.
Casting uses ``try_cast``, so ANSI mode never fails the job on bad input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import CharType, StructType, VarcharType

from loadwright.functions.tokens import (
    as_struct, cast_failed, fixed_width_starts, null_if_blank, null_if_empty,
    parse_widths, split_fields, sql_ident, sql_string, typed,
)
from loadwright.session import scratch_path

LINE = "_line"
STATUS = "_status"
REASON = "_reason"
FILE = "_file"
BLOCK = "_block"
ROW_ID = "_rid"
GOOD, REJECTED, DISCARDED = "good", "rejected", "discarded"


def read_lines(spark: SparkSession, paths: str | list[str], with_position: bool = False,
               line_sep: str | None = None) -> DataFrame:
    """Lines of text files as column ``value``.

    ``with_position`` adds the file path, the start of the file split the line
    came from, and a row id that increases along the lines of one split; the
    three are what :func:`skip_lines` needs.  They are taken directly over the
    scan, before anything can reorder rows.
    """
    df = spark.read.text(paths, lineSep=line_sep) if line_sep else spark.read.text(paths)
    if not with_position:
        return df
    return df.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW_ID),
    )


HEADING = "_heading"
SKIPPED = "skipped"


def skip_lines(lines: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file (see :func:`mark_headings`)."""
    if n <= 0:
        return lines
    return mark_headings(lines, n).where(~F.col(HEADING)).drop(HEADING)


def mark_headings(lines: DataFrame, n: int) -> DataFrame:
    """Flag the first ``n`` lines of every file in a ``_heading`` column.

    Which lines of a split are headings depends on how many lines the splits
    before it hold.  So the lines are written to the scratch folder once (the
    only scan of the text) and flagged there; where lines are staged anyway,
    :func:`flag_headings` on the written stage needs no copy.
    """
    if n <= 0:
        return lines.withColumn(HEADING, F.lit(False))
    _need_position(lines)
    path = scratch_path(lines.sparkSession, "lines")
    lines.write.parquet(path)
    return flag_headings(lines.sparkSession.read.schema(lines.schema).parquet(path), n)


def flag_headings(written: DataFrame, n: int) -> DataFrame:
    """``_heading`` for rows that were written with their position (``read_lines(with_position=True)``).

    Row ids are consecutive along a split.  Line counts per split and their
    running sum per file tell where in which splits the headings end, however
    many splits they cover; both read the three position columns only.  One row
    for each split that holds headings is joined back (AQE broadcasts these by
    their measured size).
    """
    _need_position(written)
    splits = written.groupBy(FILE, BLOCK).agg(F.min(ROW_ID).alias("_least"), F.count(F.lit(1)).alias("_lines"))
    before = F.coalesce(F.sum("_lines").over(Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = splits.withColumn("_before", before).where(F.col("_before") < n).select(
        F.col(FILE).alias("_cut_file"), F.col(BLOCK).alias("_cut_block"), (F.col("_least") + F.lit(n) - F.col("_before")).alias("_cut"))
    joined = written.join(cuts, (F.col(FILE) == F.col("_cut_file")) & (F.col(BLOCK) == F.col("_cut_block")), "left")
    return joined.select(*written.columns, F.coalesce(F.col(ROW_ID) < F.col("_cut"), F.lit(False)).alias(HEADING))


def _need_position(lines: DataFrame) -> None:
    if missing := {FILE, BLOCK, ROW_ID} - set(lines.columns):
        raise ValueError(f"skip_lines needs read_lines(..., with_position=True); missing {missing}")


def _evaluate_once(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Add columns computed exactly once per row (``fields``: name -> SQL text).

    The expressions go through a generator (``inline`` of a one-element array)
    instead of a projection.  A later filter, such as ``_status = 'good'``,
    cannot be pushed below a generator's output, so Catalyst does not copy
    the split and the casts into the filter condition (which re-evaluated
    every field per line and overflowed the 64 KB codegen method limit).
    """
    packed = ", ".join(f"{sql_string(name)}, {expr}" for name, expr in fields.items())
    return df.selectExpr("*", f"inline(array(named_struct({packed})))")


def _classify(lines: DataFrame, line_col: str, fields: StructType,
              token_of, n_tokens: str | None, structural, formats: dict[str, str] | None = None) -> DataFrame:
    """Typed values, status and reason for each line.

    ``token_of(i)`` gives the NULL-normalised text of field ``i`` (SQL text
    over the columns of ``lines``); ``structural(size)`` gives line-level
    problems as ``(condition, message)`` pairs.  Tokens and typed values come
    out of one generator; status and reason are built over its outputs.
    """
    names = fields.fieldNames()
    masks = formats or {}
    if unknown := sorted(set(masks) - set(names)):
        raise ValueError(f"formats for columns that are not declared: {unknown}")
    keep = [c for c in lines.columns if c != line_col and c not in names]
    once = {}
    for i, f in enumerate(fields.fields):
        once[f"_t{i}"] = token_of(i)
        once[f"_v{i}"] = typed(token_of(i), f.dataType, masks.get(f.name))
    if n_tokens is not None:
        once["_nf"] = n_tokens
    vals = _evaluate_once(lines, once)
    problems = list(structural("`_nf`" if n_tokens is not None else None)) + [
        (cast_failed(f"`_t{i}`", f"`_v{i}`"), f"{f.name}: not {f.dataType.simpleString()}")
        for i, f in enumerate(fields.fields)
    ] + [
        (f"char_length(`_t{i}`) > {f.dataType.length}", f"{f.name}: longer than {f.dataType.simpleString()}")
        for i, f in enumerate(fields.fields) if isinstance(f.dataType, (CharType, VarcharType))
    ]
    line = sql_ident(line_col)
    blank = f"trim({line}) = ''"
    any_problem = " OR ".join(cond for cond, _ in problems)
    reason = "concat_ws('; ', " + ", ".join(
        f"CASE WHEN {cond} THEN {sql_string(msg)} END" for cond, msg in problems) + ")"
    status = (f"CASE WHEN {blank} THEN {sql_string(DISCARDED)} WHEN {any_problem} "
              f"THEN {sql_string(REJECTED)} ELSE {sql_string(GOOD)} END")
    return vals.selectExpr(
        *[f"`_v{i}` AS {sql_ident(f.name)}" for i, f in enumerate(fields.fields)],
        f"{line} AS {sql_ident(LINE)}",
        f"{status} AS {sql_ident(STATUS)}",
        f"CASE WHEN NOT ({blank}) AND ({any_problem}) THEN {reason} END AS {sql_ident(REASON)}",
        *[sql_ident(c) for c in keep],
    )


def parse_delimited(lines: DataFrame, schema: str | StructType, delimiter: str,
                    pad_short_rows: bool = True, line_col: str = "value",
                    formats: dict[str, str] | None = None) -> DataFrame:
    """Split each line on ``delimiter`` (taken literally) into the declared columns."""
    fields = as_struct(schema)
    n = len(fields.fields)
    packed = F.struct(split_fields(F.col(line_col), delimiter).alias("_toks"))
    split = lines.select("*", F.inline(F.array(packed)))  # split once per line

    def structural(size):
        out = [(f"{size} > {n}", f"more than {n} fields")]
        if not pad_short_rows:
            out.append((f"{size} < {n}", f"fewer than {n} fields"))
        return out

    parsed = _classify(split, line_col, fields,
                       lambda i: null_if_empty(f"get(`_toks`, {i})"),
                       "size(`_toks`)", structural, formats)
    return parsed.drop("_toks")


def parse_fixed_width(lines: DataFrame, schema: str | StructType, widths: str | list[int],
                      reject_long_rows: bool = True, line_col: str = "value",
                      formats: dict[str, str] | None = None) -> DataFrame:
    """Cut each line at the given widths (counted in characters).

    A short line leaves the missing fields NULL.  Non-blank text after the last
    field rejects the line unless ``reject_long_rows`` is False.
    """
    fields = as_struct(schema)
    widths = parse_widths(widths)
    if len(widths) != len(fields.fields):
        raise ValueError(f"{len(widths)} widths for {len(fields.fields)} columns")
    starts = fixed_width_starts(widths)
    line = sql_ident(line_col)
    total = sum(widths)
    tail_len = f"length(rtrim(substring({line}, {total + 1}, {1 << 30})))" if reject_long_rows else None

    def structural(tail):
        if tail is None:
            return []
        return [(f"{tail} > 0", f"longer than {total} characters")]

    return _classify(lines, line_col, fields,
                     lambda i: null_if_blank(f"substring({line}, {starts[i]}, {widths[i]})"),
                     tail_len, structural, formats)


def good_rows(parsed: DataFrame, schema: str | StructType) -> DataFrame:
    """The typed rows that passed, declared columns only."""
    names = as_struct(schema).fieldNames()
    return parsed.where(F.col(STATUS) == GOOD).select(*names)


def line_counts(parsed: DataFrame) -> DataFrame:
    """One row: input, good, rejected and discarded line counts, in a single pass."""
    s = F.col(STATUS)
    return parsed.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(s == GOOD).alias("n_good"),
        F.count_if(s == REJECTED).alias("n_rejected"),
        F.count_if(s == DISCARDED).alias("n_discarded"),
    )


def raw_line_count(lines: DataFrame) -> int:
    """Lines in the input, before skipping and parsing."""
    return lines.count()
