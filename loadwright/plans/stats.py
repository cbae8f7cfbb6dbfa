"""Column statistics that are taken on the write of a segment and merged per snapshot.

Per segment and column: NULL count, minimum, maximum and a HyperLogLog sketch
of the distinct values.  All four merge, so the statistics of a target follow
from those of its live segments and no row of the target is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from loadwright.functions.tokens import sql_ident

STATS_SCHEMA = ("SEGMENT STRING, BUCKET INT, COLUMN_NAME STRING, N_ROWS BIGINT, N_NULL BIGINT, MIN_VALUE STRING, MAX_VALUE STRING, SKETCH BINARY")
#: log2 of the sketch's registers: a standard error of about 1 %.
SKETCH_BITS = 14


def segment_statistics(fields: list[StructField]) -> list[Column]:
    """Aggregates ``n<i>, lo<i>, hi<i>, sk<i>`` of each field (values as text)."""
    out = []
    for i, f in enumerate(fields):
        c = F.col(sql_ident(f.name))
        out += [F.count_if(c.isNull()).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
                F.hll_sketch_agg(c.cast("string"), F.lit(SKETCH_BITS)).alias(f"sk{i}")]
    return out


def merged_statistics(stats: DataFrame, fields: list[StructField]) -> DataFrame:
    """(column_name, n_rows, n_null, min_value, max_value, n_distinct) from the rows of live segments.

    Extremes are compared as values of the column's type and given as text.
    """
    least, most = F.lit(None).cast("string"), F.lit(None).cast("string")
    for f in fields:
        kind = f.dataType.simpleString()
        mine = F.col("COLUMN_NAME") == f.name
        least = F.when(F.first("COLUMN_NAME") == f.name, F.min(F.when(mine, F.col("MIN_VALUE").cast(kind))).cast("string")).otherwise(least)
        most = F.when(F.first("COLUMN_NAME") == f.name, F.max(F.when(mine, F.col("MAX_VALUE").cast(kind))).cast("string")).otherwise(most)
    return stats.groupBy(F.col("COLUMN_NAME").alias("column_name")).agg(
        F.sum("N_ROWS").alias("n_rows"), F.sum("N_NULL").alias("n_null"), least.alias("min_value"), most.alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("SKETCH")).alias("n_distinct"))
