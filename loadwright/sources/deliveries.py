"""Delivery files: listing, name parsing, and the choice of files to apply.

Plan rule (per delivery object):
  * the newest FULL is applied first -- newest by ``(file_date, file_name, path)``,
    so of equally named ones in two folders it is one; no other FULL is applied
  * then every UPDT whose file date is strictly later than that FULL's date,
    in ``(file_date, file_name, path)`` order
  * with no FULL, every UPDT is applied
  * other modes are never applied; every file not in the plan is reported

All of it is DataFrame work: the newest FULL per object is a partial
aggregate (``max`` of a struct), joined back to the names.  Only the files to
apply -- metadata, never rows -- are returned to the driver, by :func:`plan_list`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.names import (
    DATE_FIELD, MODE_FIELD, MODE_FULL, MODE_INSERT, MODE_UPDATE, base_name,
    file_date_ts, name_field,
)

NAMES_SCHEMA = "path STRING, file_name STRING, load_mode STRING, file_date STRING"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder as ``path, modificationTime, length`` (content is not read)."""
    return (spark.read.format("binaryFile").load(folder)
            .select("path", "modificationTime", "length"))


def list_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of an input folder: ``path, modificationTime, length, n_files``.

    A delivery is a file whose name carries the dot fields, or a folder with
    such a name holding part files (as a Spark job writes them).  The listing
    reads no file content.
    """
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
                 .select("path", "modificationTime", "length"))
    except Exception as exc:  # an empty or missing folder has nothing to apply
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, n_files bigint")
        raise
    return group_delivery_files(files)


def delivery_path(path: Column) -> Column:
    """The delivery a file belongs to: itself when named with the dot fields, else its folder."""
    named = F.size(F.split(base_name(path), "\\.")) >= DATE_FIELD
    return F.when(named, path).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def group_delivery_files(files: DataFrame) -> DataFrame:
    """File listing (``path, modificationTime, length``) -> one row per delivery."""
    return files.groupBy(delivery_path(F.col("path")).alias("path")).agg(
        F.max("modificationTime").alias("modificationTime"),
        F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("n_files"),
    )


def parse_delivery_names(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """``path`` -> ``path, file_name, load_mode, file_date`` (+ any other listing columns)."""
    name = base_name(F.col(path_col))
    others = [c for c in listing.columns if c != path_col]
    return listing.select(
        F.col(path_col).alias("path"),
        name.alias("file_name"),
        name_field(name, MODE_FIELD).alias("load_mode"),
        name_field(name, DATE_FIELD).alias("file_date"),
        *others,
    )


def plan_deliveries(names: DataFrame, keys=None, by: list[str] | None = None) -> DataFrame:
    """The files to apply, with ``effective_mode`` (UPDT without keys -> INST).

    ``by`` plans several delivery objects at once (e.g. ``["object"]``).
    """
    from loadwright.functions.keys import parse_keys

    by = list(by or [])
    fulls = names.where(F.col("load_mode") == MODE_FULL)
    newest_full = F.max(F.struct("file_date", "file_name", "path"))
    if by:
        joined = names.join(fulls.groupBy(*by).agg(newest_full.alias("_full")), by, "left")
    else:
        # a single object: the newest FULL is a scalar subquery
        joined = names.withColumn("_full", fulls.select(newest_full).scalar())
    full_date = F.col("_full.file_date")
    is_newest_full = (F.col("load_mode") == MODE_FULL) & (F.col("path") == F.col("_full.path"))
    later_update = (F.col("load_mode") == MODE_UPDATE) & (
        full_date.isNull() | (F.col("file_date") > full_date))
    update_mode = MODE_UPDATE if parse_keys(keys) else MODE_INSERT
    return (joined.where(is_newest_full | later_update)
            .withColumn("effective_mode",
                        F.when(F.col("load_mode") == MODE_FULL, F.lit(MODE_FULL))
                        .otherwise(F.lit(update_mode)))
            .withColumn("file_ts", file_date_ts("file_date"))
            .drop("_full"))


def unprocessed_deliveries(names: DataFrame, plan: DataFrame) -> DataFrame:
    """Files not in the plan (older FULLs, stale UPDTs, unknown modes)."""
    return names.join(plan.select("path"), "path", "left_anti")


def plan_list(plan: DataFrame) -> list[dict]:
    """The ordered plan as a small list of dicts (file metadata only).

    The plan is one row per delivery file and comes to the driver anyway, so
    it is ordered there (NULL dates first, as ``orderBy`` would) instead of by
    a global sort, which would cost a sampling job.
    """
    rows = [r.asDict() for r in plan.collect()]
    return sorted(rows, key=lambda r: (r["file_date"] is not None, r["file_date"] or "", r["file_name"], r["path"]))
