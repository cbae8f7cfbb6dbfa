"""Reject capture and the reject-limit gate.

Fixed values that must equal the reference:
  - the rejected table is ``S_ID, METADATA_TM_INSERT, LINE`` (whole line)
  - the default limit is 1000000 rejected rows
  - the gate fails when the run's rejects are greater than *or equal to* the limit
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.sources.textscan import LINE, REASON, REJECTED, STATUS

DEFAULT_THRESHOLD = 1_000_000
REJECTED_SCHEMA = "S_ID BIGINT, METADATA_TM_INSERT TIMESTAMP_NTZ, LINE STRING"


class RejectLimitExceeded(RuntimeError):
    pass


def ts_literal(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """Lines that failed, with the reason (for inspection)."""
    return parsed.where(F.col(STATUS) == REJECTED).select(F.col(LINE), F.col(REASON))


def rejected_rows(parsed: DataFrame, run_id: int, run_ts: str, with_reason: bool = False) -> DataFrame:
    """Rows for the rejected table of one run (``REASON`` added on request)."""
    cols = [
        F.lit(int(run_id)).cast("bigint").alias("S_ID"),
        ts_literal(run_ts).alias("METADATA_TM_INSERT"),
        F.col(LINE).alias("LINE"),
    ]
    if with_reason:
        cols.append(F.col(REASON).alias("REASON"))
    return parsed.where(F.col(STATUS) == REJECTED).select(*cols)


@dataclass(frozen=True)
class GateResult:
    n_rejected: int
    threshold: int

    @property
    def passed(self) -> bool:
        return self.n_rejected < self.threshold


def reject_gate(n_rejected: int, threshold: int = DEFAULT_THRESHOLD, raise_on_fail: bool = True) -> GateResult:
    """Fail when the rejects of the run reach the threshold (``>=``)."""
    result = GateResult(int(n_rejected), int(threshold))
    if raise_on_fail and not result.passed:
        raise RejectLimitExceeded(
            f"{result.n_rejected} rejected rows reach the limit of {result.threshold}")
    return result


def gate_table(counts: DataFrame, thresholds: list[int]) -> DataFrame:
    """Evaluate the gate for several limits against a one-row count frame.

    ``counts`` needs ``n_rejected``; the limits are a tiny literal array that is
    exploded next to the single count row, so nothing is collected.
    """
    arr = F.array(*[F.lit(int(t)).cast("bigint") for t in thresholds])
    return (counts.select("*", F.explode(arr).alias("threshold"))
            .withColumn("passed", F.col("n_rejected") < F.col("threshold")))
