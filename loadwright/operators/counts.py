"""Row counts, reconciliation and run-journal readers.

Counts that a load needs are taken as few times as possible: the stage is
counted once when it is written (an ``Observation`` on the write), and the
target after a merge is counted from the written snapshot's metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.operators.transform import where_equal


class ReconciliationError(RuntimeError):
    pass


def row_count(df: DataFrame, col: str | None = None, value=None) -> int:
    return where_equal(df, col, value).count()


def reconcile(mode: str, before: int, stage: int, after: int, removed: int | None = None) -> None:
    """Check the arithmetic of a load.

    FULL: after == stage.  INST: after == before + stage.
    UPDT: after == before - removed + stage (``removed`` = target rows whose key
    was staged).  The original tool only checked FULL.
    """
    if mode == "FULL":
        expected = stage
    elif mode == "INST":
        expected = before + stage
    elif mode == "UPDT":
        if removed is None:
            return
        expected = before - removed + stage
    else:
        raise ValueError(mode)
    if after != expected:
        raise ReconciliationError(f"{mode}: {after} rows after load, expected {expected}")


def run_status(status_log: DataFrame) -> DataFrame:
    """Current state of each run from the append-only status log.

    ``status_log``: ``S_ID, S_PROCESS, S_PROCESS_VALUE, S_STATUS, TS, SEQ`` where
    ``SEQ`` breaks ties between rows of the same instant.  One row per run:
    the first time seen, the status of the latest row, the latest time.
    """
    order = F.struct("TS", "SEQ")
    return status_log.groupBy("S_ID").agg(
        F.max_by("S_PROCESS", order).alias("S_PROCESS"),
        F.max_by("S_PROCESS_VALUE", order).alias("S_PROCESS_VALUE"),
        F.max_by("S_STATUS", order).alias("S_STATUS"),
        F.min("TS").alias("S_INSDATE"),
        F.max("TS").alias("S_UPDDATE"),
    )


def latest_run(runs: DataFrame, process: str | None = None, value: str | None = None) -> DataFrame:
    """Highest run id per (process, value); filtered to one pair when given."""
    df = runs
    if process is not None:
        df = df.where(F.col("S_PROCESS") == process)
    if value is not None:
        df = df.where(F.col("S_PROCESS_VALUE") == value)
    return df.groupBy("S_PROCESS", "S_PROCESS_VALUE").agg(F.max("S_ID").alias("S_ID"))
