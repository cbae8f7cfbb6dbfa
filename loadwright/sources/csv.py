"""Tables uploaded as CSV: a header row and inferred column types.

Type inference reads the data an extra time; it exists for the interactive
modelling entry point.  Pass ``schema`` to skip inference on large inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str | None = None,
             sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep)
    if schema:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)
