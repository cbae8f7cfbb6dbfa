"""Run journal: one status log of runs and an event table.

Fixed values that must equal the reference (event names of the run detail):
  Dataloader (Begin / End), Table_Creation, Input_file, NB_Rows_input_file,
  NBRows_before_loading, Loadmode, New_Loadmode, WARNING, NB_Rows_bad_file,
  NBRows_rejected_table, ERROR, NB_Rows_discard_file, NBRows_temp_table,
  NBRows_table_after_truncate, NBRows_table_after_loading=NBRows_temp_table,
  NBRows_table_after_delete_request, Statistics_Calculation,
  NBRows_after_loading, File_Not_Processed
Status 0 = started (a failed run stays 0), 1 = finished.

The status log is append-only: opening and closing a run each add a row,
and :func:`loadwright.operators.counts.run_status` reads the current state.
Events of one delivery are buffered and appended in one write.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.operators.counts import run_status
from loadwright.plans.store import TableStore

RUN_TABLE = "LOAD_RUN"
EVENT_TABLE = "LOAD_EVENT"
RUN_SCHEMA = ("S_ID BIGINT, S_PROCESS STRING, S_PROCESS_VALUE STRING, S_STATUS INT, "
              "TS TIMESTAMP_NTZ, SEQ BIGINT")
EVENT_SCHEMA = "SD_ID BIGINT, S_ID BIGINT, SD_EVENT STRING, SD_EVENT_VALUE STRING, SD_INSDATE TIMESTAMP_NTZ"
STATUS_STARTED, STATUS_DONE = 0, 1


def now_ts() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


class Journal:
    def __init__(self, store: TableStore, prefix: str = ""):
        self.store = store
        self.spark: SparkSession = store.spark
        self.runs = f"{prefix}{RUN_TABLE}"
        self.events_table = f"{prefix}{EVENT_TABLE}"
        self._buffer: list[tuple] = []
        self._next_event: int | None = None

    def ensure(self) -> None:
        self.store.ensure_append(self.runs, RUN_SCHEMA)
        self.store.ensure_append(self.events_table, EVENT_SCHEMA)

    def _next_id(self, table: str, col: str) -> int:
        current = self.store.read(table).agg(F.max(col)).first()[0]
        return int(current or 0) + 1

    def _status_row(self, run_id: int, process: str, value: str, status: int, ts: str, seq: int) -> None:
        df = self.spark.createDataFrame([(run_id, process, value, status, datetime.fromisoformat(ts), seq)],
                                        RUN_SCHEMA)
        self.store.append(self.runs, df)

    def open_run(self, process: str, value: str, ts: str | None = None) -> int:
        """Register a run (status 0) and return its id; one writer per journal."""
        run_id = self._next_id(self.runs, "S_ID")
        self._status_row(run_id, process, value, STATUS_STARTED, ts or now_ts(), 0)
        self._process = (process, value)
        return run_id

    def close_run(self, run_id: int, ts: str | None = None) -> None:
        process, value = self._process
        self._status_row(run_id, process, value, STATUS_DONE, ts or now_ts(), 1)

    def event(self, run_id: int, name: str, value="", ts: str | None = None) -> None:
        self._buffer.append((run_id, name, "" if value is None else str(value), ts or now_ts()))

    def flush(self) -> None:
        if not self._buffer:
            return
        if self._next_event is None:
            self._next_event = self._next_id(self.events_table, "SD_ID")
        rows = []
        for run_id, name, value, ts in self._buffer:
            rows.append((self._next_event, run_id, name, value, datetime.fromisoformat(ts)))
            self._next_event += 1
        self.store.append(self.events_table, self.spark.createDataFrame(rows, EVENT_SCHEMA))
        self._buffer = []

    def append_events(self, run_id: int, name: str, values: DataFrame, ts: str) -> None:
        """One event per row of ``values`` (one column), written by Spark; the ids grow but have gaps."""
        self.flush()
        first = self._next_id(self.events_table, "SD_ID")
        value = F.col(values.columns[0]).cast("string")
        self.store.append(self.events_table, values.select(
            (F.lit(first).cast("bigint") + F.monotonically_increasing_id()).alias("SD_ID"), F.lit(run_id).cast("bigint").alias("S_ID"),
            F.lit(name).alias("SD_EVENT"), value.alias("SD_EVENT_VALUE"), F.lit(ts).cast("timestamp_ntz").alias("SD_INSDATE")))
        self._next_event = None

    def finished(self, process: str, value: str) -> bool:
        """True when a run of ``(process, value)`` has reached status 1."""
        if not self.store.exists(self.runs):
            return False
        done = self.store.read(self.runs).where(
            (F.col("S_PROCESS") == process) & (F.col("S_PROCESS_VALUE") == value)
            & (F.col("S_STATUS") == STATUS_DONE))
        return not done.isEmpty()

    def applied_files(self, value: str) -> DataFrame:
        """Names of the delivery files that runs report as switched into the target of ``value``.

        This is the report of the journal; which deliveries a later run leaves
        out is decided by the target's own ledger, which changes with its rows.

        A file counts as applied when its run logged an ``NBRows_after_loading``
        event after the file's ``Input_file`` event.  That covers loads of one
        delivery at a time (one switch per file), bulk loads (one switch after all
        inputs) and runs that failed part way (files after the last switch are
        not applied).  Two small aggregates and joins over the journal.
        """
        if not (self.store.exists(self.runs) and self.store.exists(self.events_table)):
            return self.spark.createDataFrame([], "file_name STRING")
        runs = self.store.read(self.runs).where(F.col("S_PROCESS_VALUE") == value).select("S_ID").distinct()
        ev = self.store.read(self.events_table).join(runs, "S_ID", "left_semi")
        last_switch = (ev.where(F.col("SD_EVENT") == "NBRows_after_loading")
                       .groupBy("S_ID").agg(F.max("SD_ID").alias("_switch")))
        inputs = ev.where(F.col("SD_EVENT") == "Input_file")
        return (inputs.join(last_switch, "S_ID").where(F.col("SD_ID") < F.col("_switch"))
                .select(F.col("SD_EVENT_VALUE").alias("file_name")).distinct())

    def compact(self) -> None:
        """Rewrite both journal tables as a few files (see ``TableStore.compact``)."""
        for name in (self.runs, self.events_table):
            if self.store.exists(name):
                self.store.compact(name)

    def status(self) -> DataFrame:
        return run_status(self.store.read(self.runs))

    def events(self, run_id: int | None = None) -> DataFrame:
        df = self.store.read(self.events_table)
        return df if run_id is None else df.where(F.col("S_ID") == run_id)
