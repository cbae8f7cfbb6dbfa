"""Catalog tables below one root folder.

Targets are segments behind a view that is switched in one call (see
:mod:`loadwright.plans.target`).  Append-only tables (rejected lines, run
journal, ledgers) live in one folder each and grow with ``INSERT INTO``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadwright.functions.tokens import as_struct
from loadwright.plans.target import Snapshot, TargetTable

_COMPACTED = re.compile(r"\.c(\d+)$")


class TableStore:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self._targets: dict[str, TargetTable] = {}

    def qualified(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def _create(self, name: str, schema: StructType, location: str) -> None:
        """Declare an empty table: one catalog call, no Spark job.

        The folder appears with the first write; until then the table reads as empty.
        """
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {self.qualified(name)} ({cols}) USING parquet LOCATION '{location}'")

    def target(self, name: str) -> TargetTable:
        """The target of that name (see ``TargetTable.ensure``); target names are upper case."""
        name = name.upper()
        return self._targets.setdefault(name, TargetTable(self, name))

    def snapshot(self, name: str) -> Snapshot:
        return self.target(name).snapshot()

    def version(self, name: str) -> int:
        return self.snapshot(name).version

    def ensure_append(self, name: str, schema: str | StructType) -> bool:
        if self.exists(name):
            return False
        self._create(name, as_struct(schema), f"{self.root}/{name}")
        return True

    def location(self, name: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(name)}").where(
            F.col("col_name") == "Location").collect()
        return rows[0]["data_type"]

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.qualified(name))

    def drop_folder(self, path: str) -> None:
        """Remove a folder that no table points at (a stage, an old version)."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def folders(self, path: str) -> list[str]:
        """Names of what lies in a folder; empty when there is none."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        return self.target(name).vacuum(keep)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.insertInto(self.qualified(name))

    def compact(self, name: str) -> str:
        """Rewrite an append-only table as a few right-sized files; return the new folder.

        Each append adds at least one small file, so a journal written by many
        runs becomes thousands of tiny files that every read must list and
        open.  The rows are rewritten into a sibling folder (``<name>.c<n>``)
        with a ``rebalance`` hint, so AQE cuts the output at its advisory size
        instead of one task or one file per old append; then the table is
        switched to it, as a snapshot is.  Later appends go to the new folder.
        """
        current = self.location(name).rstrip("/")
        m = _COMPACTED.search(current)
        folder = f"{self.root}/{name}.c{(int(m.group(1)) + 1) if m else 1:06d}"
        self.read(name).hint("rebalance").write.mode("errorifexists").parquet(folder)
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} SET LOCATION '{folder}'")
        self.spark.sql(f"REFRESH TABLE {self.qualified(name)}")
        return folder
