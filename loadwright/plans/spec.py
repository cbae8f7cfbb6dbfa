"""Load specification: what one delivery object looks like and how it loads.

This replaces the shell ``.properties`` file of the original tool.  Column
types are Spark DDL.  Fixed values that must equal the reference:
  - the target table is ``SOURCE_BASE_OBJECT`` upper-cased unless a custom
    name is given (also upper-cased)
  - the reject limit defaults to 1000000
  - an empty key list turns UPDT into INST
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from loadwright.functions.keys import BUCKET_COLUMN, parse_keys
from loadwright.functions.tokens import as_struct, parse_widths
from loadwright.operators.rejects import DEFAULT_THRESHOLD
from loadwright.operators.transform import AUDIT_FILE, AUDIT_INSERT


@dataclass
class LoadSpec:
    object_name: str                       # "source.base.object"
    columns: str                           # target columns, Spark DDL
    delimiter: str | None = None           # None/"" -> fixed width
    widths: list[int] | str | None = None  # fixed-width column widths, in characters
    stage_columns: str | None = None       # stage columns when they differ (DDL)
    formats: dict[str, str] | None = None  # stage column: datetime pattern it is written in
    select: list[str] | None = None        # stage -> target expressions (default: all)
    skip: int = 0                          # heading lines per file
    threshold: int = DEFAULT_THRESHOLD     # reject limit (fails at >=)
    column_id: list[str] | str | None = None   # delivery key: duplicate gate + UPDT match
    table_key: list[str] | str | None = None   # target primary key (checked, warned on mismatch)
    steps: list[str] = field(default_factory=list)  # ordered SELECTs over {stage}
    custom_table_name: str | None = None
    pad_short_rows: bool = True
    analyze: bool = True                   # gather table statistics after each run (size, no scan)
    analyze_scan: bool = False             # also count the rows of live segments by reading them
    column_stats: bool = False             # nulls, extremes and distinct counts per column, taken on each write
    buckets: int | None = None             # hash-partition the target by the delivery key
    key_index: bool = False                # keep the primary keys of each segment in hash buckets
    keep_stage: bool = False               # keep the staging folder after a successful run
    line_sep: str | None = None            # line separator when not \n, \r\n or \r

    def __post_init__(self):
        if not self.delimiter and not self.widths:
            raise ValueError("either a delimiter or the fixed widths are required")
        if self.widths is not None:
            self.widths = parse_widths(self.widths)
        self.column_id = parse_keys(self.column_id)
        self.table_key = parse_keys(self.table_key)
        if self.buckets is not None and (not self.column_id or int(self.buckets) < 1):
            raise ValueError("buckets need a delivery key (column_id) and a positive count")
        if self.key_index and not self.table_key:
            raise ValueError("a key index needs a primary key (table_key)")
        parts = self.object_name.lower().split(".")
        if len(parts) != 3 or not all(parts):
            raise ValueError("object_name must be 'source.base.object'")

    @property
    def table_name(self) -> str:
        if self.custom_table_name:
            return self.custom_table_name.upper()
        return "_".join(self.object_name.split(".")).upper()

    @property
    def rejected_table_name(self) -> str:
        return f"{self.table_name}_REJECTED"

    @property
    def target_schema(self) -> StructType:
        """Audit columns first, then the declared columns."""
        audit = [StructField(AUDIT_FILE, TimestampNTZType()), StructField(AUDIT_INSERT, TimestampNTZType())]
        return StructType(audit + list(as_struct(self.columns).fields))

    @property
    def stored_schema(self) -> StructType:
        """Target schema as stored: with the bucket column last when the target is bucketed."""
        if not self.buckets:
            return self.target_schema
        return StructType(list(self.target_schema.fields) + [StructField(BUCKET_COLUMN, IntegerType())])

    @property
    def parse_schema(self) -> StructType:
        return as_struct(self.stage_columns or self.columns)

    @property
    def keys_differ(self) -> bool:
        return bool(self.column_id and self.table_key and self.column_id != self.table_key)
