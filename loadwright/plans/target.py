"""Target tables: immutable segments behind one name that is switched in one call.

Plain Parquet tables refuse ``DELETE`` and ``MERGE``, and overwriting the path
a query is reading loses its input.  So a target is three catalog objects:

* ``<TABLE>__PARTS``   a Parquet table with one partition per *segment* (and
  bucket): the files that one load wrote, never changed afterwards
* ``<TABLE>__LEDGER``  append-only: each commit with the segments that are live
  after it, and the deliveries it applied (path, time, size) or passed over
* ``<TABLE>``          a view over the live segments, which readers use

A load writes its new rows as one segment, adds its partitions, appends its
ledger rows, and then replaces the view.  That last call is the switch: before
it nothing of the load can be seen, after it everything, however many buckets
or deliveries took part.  The view's properties carry the commit's id, and
ledger rows count only if their commit is the current one or the parent of
another commit, so rows and the fact "these deliveries are applied" change
together.  A driver lost at any point leaves an unreferenced folder, partition
or ledger row; :meth:`TargetTable.vacuum` removes the first two.

An append adds a segment and leaves all files as they are.  An update rewrites
the segments (or buckets) that hold one of its keys.  One writer per table is
assumed.  Segments of many small appends are merged by :meth:`TargetTable.compact`.
A target with a declared key index keeps the primary keys of each segment in
hash buckets (see :mod:`loadwright.plans.keyindex`).
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadwright.functions.tokens import as_struct, sql_ident, sql_string
from loadwright.plans.keyindex import KeyIndex
from loadwright.plans.stats import STATS_SCHEMA, merged_statistics, segment_statistics

SEGMENT = "_segment"
LEDGER_SCHEMA = ("KIND STRING, VERSION BIGINT, COMMIT_ID STRING, PARENT_ID STRING, RUN_ID BIGINT, PATH STRING, FILE_NAME STRING, "
                 "MODIFIED TIMESTAMP, LENGTH BIGINT, LOAD_MODE STRING, FILE_DATE STRING, N_ROWS BIGINT, LIVE STRING")
#: Kinds of ledger rows: a commit, a delivery applied by it, a delivery that a run's plan passed over.
COMMIT, APPLIED, PASSED = "commit", "applied", "passed"
IDENTITY = ["path", "modificationTime", "length"]
_PROPERTY = "loadwright.commit"
_KEY_INDEX = "loadwright.key_index"
_FOLDER = re.compile(rf"{SEGMENT}=(\d+)-[0-9a-f]+")


@dataclass(frozen=True)
class Segment:
    """Files of one load; ``buckets`` are those still live (None: not bucketed)."""

    name: str
    rows: int
    buckets: tuple[int, ...] | None = None

    @property
    def version(self) -> int:
        return int(self.name.split("-")[0])


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    commit: str = ""
    rows: int = 0
    segments: tuple[Segment, ...] = ()

    def without(self, names: set[str]) -> tuple[Segment, ...]:
        return tuple(s for s in self.segments if s.name not in names)

    def split_buckets(self, buckets: set[int]) -> tuple[tuple[Segment, ...], tuple[Segment, ...]]:
        """(segments cut down to ``buckets``, segments cut down to all others)."""
        inside, outside = [], []
        for s in self.segments:
            for part, test in ((inside, True), (outside, False)):
                if mine := tuple(b for b in s.buckets or () if (b in buckets) is test):
                    part.append(Segment(s.name, s.rows, mine))
        return tuple(inside), tuple(outside)


@dataclass
class Delivery:
    """Identity of a delivery and what its load did with it."""

    path: str
    file_name: str
    modified: datetime | None = None
    length: int | None = None
    load_mode: str | None = None
    file_date: str | None = None
    rows: int | None = None


@dataclass
class TargetTable:
    store: "object"                 # TableStore
    name: str
    _known: dict[str, Snapshot] = field(default_factory=dict)

    @cached_property
    def bucket_col(self) -> str | None:
        """The partition column beside the segment, if the target has one."""
        listed = self.spark.catalog.listColumns(self.store.qualified(self.parts_name))
        return next((c.name for c in listed if c.isPartition and c.name != SEGMENT), None)

    @cached_property
    def key_index(self) -> KeyIndex | None:
        """The declared key index; kept with the table, so every writer of it maintains the index."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.store.qualified(self.parts_name)}").collect()
        said = {r["key"]: r["value"] for r in rows}.get(_KEY_INDEX)
        return KeyIndex(self._keys_root, *map(tuple, json.loads(said))) if said else None

    def declare_key_index(self, keys: list[str], extra: list[str] = ()) -> KeyIndex:
        """Index the ``keys`` of all segments written from now on (``extra``: columns stored beside them).

        Segments that are live already are read as before; :meth:`compact` indexes them.
        """
        index = KeyIndex(self._keys_root, tuple(keys), tuple(dict.fromkeys([*extra] + ([self.bucket_col] if self.bucket_col else []))))
        if self.key_index != index:
            said = sql_string(json.dumps([index.keys, index.extra]))
            self.spark.sql(f"ALTER TABLE {self.store.qualified(self.parts_name)} SET TBLPROPERTIES ('{_KEY_INDEX}' = {said})")
            self.key_index = index
        return index

    @property
    def _keys_root(self) -> str:
        return f"{self.store.root}/{self.name}__KEYS"

    @property
    def parts_name(self) -> str:
        return f"{self.name}__PARTS"

    @property
    def ledger_name(self) -> str:
        return f"{self.name}__LEDGER"

    @property
    def stats_name(self) -> str:
        return f"{self.name}__STATS"

    @property
    def spark(self):
        return self.store.spark

    def ensure(self, schema: str | StructType, bucket_col: str | None = None) -> bool:
        """Create an empty target when absent; True when created.  Catalog calls only."""
        if self.store.exists(self.name):
            return False
        fields = [f for f in as_struct(schema).fields if f.name != bucket_col]
        columns = [f"{sql_ident(f.name)} {f.dataType.simpleString()}" for f in fields]
        keys = [f"{sql_ident(SEGMENT)} STRING"] + ([f"{sql_ident(bucket_col)} INT"] if bucket_col else [])
        by = ", ".join(k.rsplit(" ", 1)[0] for k in keys)
        # a run that was lost between these calls left some of them: they hold nothing yet
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.store.qualified(self.parts_name)} ({', '.join(columns + keys)}) USING parquet "
                       f"PARTITIONED BY ({by}) LOCATION '{self.store.root}/{self.name}'")
        self.store.ensure_append(self.ledger_name, LEDGER_SCHEMA)
        self._point_view(Snapshot())
        return True

    # -- reading -----------------------------------------------------------
    def snapshot(self) -> Snapshot:
        """What is live now: the commit named by the view, looked up in the ledger."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.store.qualified(self.name)}").collect()
        commit = {r["key"]: r["value"] for r in rows}.get(_PROPERTY, "")
        if not commit:
            return Snapshot()
        if commit not in self._known:
            r = self.ledger().where((F.col("KIND") == COMMIT) & (F.col("COMMIT_ID") == commit)).select("VERSION", "N_ROWS", "LIVE").first()
            self._known = {commit: Snapshot(r.VERSION, commit, r.N_ROWS, _segments(r.LIVE))}
        return self._known[commit]

    def read(self) -> DataFrame:
        return self.store.read(self.name)

    def ledger(self) -> DataFrame:
        return self.store.read(self.ledger_name)

    def parts(self, segments: tuple[Segment, ...]) -> DataFrame:
        """Rows of the given segments with their ``_segment`` (pruned to those partitions)."""
        return self.store.read(self.parts_name).where(_condition(segments, self.bucket_col))

    def key_rows(self, segments: tuple[Segment, ...], staged: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
        """(keys, extra) of the rows of ``segments`` that may hold a staged key.

        Indexed segments give the buckets of the staged keys only, others the key columns of all their rows.
        """
        columns = list(dict.fromkeys([*keys, *extra]))
        index, held = self.key_index, {}
        if index and list(index.keys) == list(keys) and set(columns) <= set(index.columns):
            held = index.counts(self.store, [s for s in segments if s.rows])
        plain = tuple(s for s in segments if s.name not in held)
        rows = self.parts(plain).select(*columns)
        if held:
            found = index.read(self.spark, self.read().schema, held, staged)
            rows = rows.unionByName(found.where(_condition(tuple(s for s in segments if s.name in held), self.bucket_col)).select(*columns))
        return rows

    def rows_of(self, segments: tuple[Segment, ...]) -> DataFrame:
        return self.parts(segments).select(*self.read().columns)

    def committed(self) -> DataFrame:
        """Ledger rows of commits that took effect: the current one and every parent of another."""
        ledger, now = self.ledger(), self.snapshot().commit
        commits = ledger.where(F.col("KIND") == COMMIT)
        valid = commits.select(F.col("PARENT_ID").alias("valid")).union(self.spark.sql(f"SELECT {sql_string(now)} AS valid")).distinct()
        return ledger.join(valid, ledger["COMMIT_ID"] == valid["valid"], "left_semi")

    def retired(self) -> DataFrame:
        """(path, modificationTime, length) of the deliveries no later run should plan again: applied, or passed over.

        The original moves every file to its history folder after a run;
        without the second kind an old FULL or a stale UPDT would become the
        plan of the next run and roll the target back.
        """
        identity = [F.col(a).alias(b) for a, b in zip(("PATH", "MODIFIED", "LENGTH"), IDENTITY)]
        applied = self.committed().where(F.col("KIND") == APPLIED).select(*identity)
        return applied.union(self.ledger().where(F.col("KIND") == PASSED).select(*identity)).distinct()

    # -- writing -----------------------------------------------------------
    def pass_over(self, names: DataFrame, run_id: int) -> None:
        """Record the deliveries that a plan left out (written by Spark)."""
        known = set(names.columns)
        get = lambda c, t: F.col(c).cast(t) if c in known else F.lit(None).cast(t)
        null = lambda t: F.lit(None).cast(t)
        rows = names.select(F.lit(PASSED).alias("KIND"), null("bigint").alias("VERSION"), null("string").alias("COMMIT_ID"), null("string").alias("PARENT_ID"),
                            F.lit(run_id).cast("bigint").alias("RUN_ID"), get("path", "string").alias("PATH"), get("file_name", "string").alias("FILE_NAME"),
                            get("modificationTime", "timestamp").alias("MODIFIED"), get("length", "bigint").alias("LENGTH"),
                            get("load_mode", "string").alias("LOAD_MODE"), get("file_date", "string").alias("FILE_DATE"),
                            null("bigint").alias("N_ROWS"), null("string").alias("LIVE"))
        self.store.append(self.ledger_name, rows)

    def write(self, df: DataFrame, buckets: list[int] | None = None, statistics: bool = False) -> Segment:
        """Write ``df`` as a new segment that no reader sees yet; its rows are counted by the write itself."""
        name = f"{self.snapshot().version + 1:06d}-{uuid.uuid4().hex[:8]}"
        path = self._folder(name)
        obs = Observation(f"{self.name}_{name}")
        measures = [F.count(F.lit(1)).alias("rows")]
        declared = [f for f in df.schema.fields if f.name != self.bucket_col]
        if statistics and not self.bucket_col:
            measures += segment_statistics(declared)
        counted = df.observe(obs, *measures)
        if self.bucket_col:  # AQE splits a hot bucket over several tasks
            counted.hint("rebalance", self.bucket_col).write.mode("errorifexists").partitionBy(self.bucket_col).parquet(path)
        else:
            counted.write.mode("errorifexists").parquet(path)
        found = obs.get
        if statistics:
            self._store_statistics(name, declared, found)
        if self.key_index:
            self.key_index.write(self.written(Segment(name, 0)), name, int(found["rows"]))
        return Segment(name, int(found["rows"]), tuple(sorted(buckets)) if self.bucket_col and buckets is not None else None)

    def switch(self, segment: Segment, kept: tuple[Segment, ...], rows: int, deliveries: list[Delivery] = (), run_id: int | None = None) -> Snapshot:
        """Make ``kept`` and ``segment`` the live rows, ``rows`` in all, and the deliveries applied: one catalog call decides."""
        before = self.snapshot()
        live = kept + ((segment,) if segment.rows or not kept else ())
        after = Snapshot(before.version + 1, uuid.uuid4().hex, rows, live)
        if segment in live:
            self._add_partitions(segment)
        self._record(before, after, deliveries, run_id)
        self._point_view(after)
        self._known = {after.commit: after}
        return after

    def written(self, segment: Segment) -> DataFrame:
        """Rows of a segment that is written but not switched in."""
        schema = self.store.read(self.parts_name).drop(SEGMENT).schema
        return self.spark.read.schema(schema).parquet(self._folder(segment.name))

    def _folder(self, segment: str) -> str:
        return f"{self.store.root}/{self.name}/{SEGMENT}={segment}"

    def _add_partitions(self, segment: Segment) -> None:
        path = self._folder(segment.name)
        if self.bucket_col:
            parts = [f"PARTITION ({sql_ident(SEGMENT)} = {sql_string(segment.name)}, {sql_ident(self.bucket_col)} = {b}) "
                     f"LOCATION '{path}/{self.bucket_col}={b}'" for b in segment.buckets or ()]
        else:
            parts = [f"PARTITION ({sql_ident(SEGMENT)} = {sql_string(segment.name)}) LOCATION '{path}'"]
        if parts:
            self.spark.sql(f"ALTER TABLE {self.store.qualified(self.parts_name)} ADD {' '.join(parts)}")
            self.spark.sql(f"REFRESH TABLE {self.store.qualified(self.parts_name)}")

    def _record(self, before: Snapshot, after: Snapshot, deliveries: list[Delivery], run_id: int | None) -> None:
        live = json.dumps([[s.name, s.rows, s.buckets] for s in after.segments])
        rows = [(COMMIT, after.version, after.commit, before.commit, run_id, None, None, None, None, None, None, after.rows, live)]
        rows += [(APPLIED, after.version, after.commit, before.commit, run_id, d.path, d.file_name, d.modified, d.length, d.load_mode, d.file_date, d.rows, None)
                 for d in deliveries]
        self.store.append(self.ledger_name, self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1))

    def _point_view(self, snapshot: Snapshot) -> None:
        """The switch: one call replaces the view's segments and the commit it names."""
        schema = self.store.read(self.parts_name).schema
        columns = ", ".join(sql_ident(f.name) for f in schema.fields if f.name != SEGMENT)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.store.qualified(self.name)} ({columns}) "
            f"TBLPROPERTIES ('{_PROPERTY}' = '{snapshot.commit}', 'loadwright.version' = '{snapshot.version}', 'loadwright.rows' = '{snapshot.rows}') "
            f"AS SELECT {columns} FROM {self.store.qualified(self.parts_name)} WHERE {_condition(snapshot.segments, self.bucket_col)}")

    # -- statistics and housekeeping ----------------------------------------
    def _store_statistics(self, segment: str, fields: list, found: dict) -> None:
        self.store.ensure_append(self.stats_name, STATS_SCHEMA)
        if self.bucket_col:  # live by bucket, so one row per bucket and column, from the new segment alone
            per = self.written(Segment(segment, 0)).groupBy(F.col(self.bucket_col).alias("b")).agg(F.count(F.lit(1)).alias("rows"), *segment_statistics(fields))
        else:
            per = self.spark.createDataFrame([(0, *(found[k] for k in ["rows"] + [c for c in found if c != "rows"]))],
                                             "b int, " + ", ".join(["rows bigint"] + [f"{sql_ident(c)} {_kind(c)}" for c in found if c != "rows"]))
        each = F.explode(F.array(*(F.struct(F.lit(f.name).alias("c"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"),
                                            F.col(f"sk{i}").alias("sk")) for i, f in enumerate(fields)))).alias("s")
        out = per.select("b", "rows", each).select(F.lit(segment).alias("SEGMENT"), F.col("b").cast("int").alias("BUCKET"), F.col("s.c").alias("COLUMN_NAME"),
                                                   F.col("rows").alias("N_ROWS"), F.col("s.n").alias("N_NULL"), F.col("s.lo").alias("MIN_VALUE"),
                                                   F.col("s.hi").alias("MAX_VALUE"), F.col("s.sk").alias("SKETCH"))
        self.store.append(self.stats_name, out)

    def column_statistics(self) -> DataFrame:
        """(column_name, n_rows, n_null, min_value, max_value, n_distinct) of the live rows, merged from those of the segments.

        All but the distinct count (an estimate) are exact.  No row of the target is read.
        """
        segments = self.snapshot().segments
        live = [(s.name, b) for s in segments for b in (s.buckets if s.buckets is not None else (0,))]
        keys = self.spark.createDataFrame(live, "SEGMENT string, BUCKET int")
        fields = [f for f in self.read().schema.fields if f.name != self.bucket_col]
        return merged_statistics(self.store.read(self.stats_name).join(keys, ["SEGMENT", "BUCKET"], "left_semi"), fields)

    def analyze(self, scan: bool = False, columns: bool = False) -> None:
        """Catalog statistics for the optimizer: sizes by default, of live segments' rows with ``scan`` (and ``columns``)."""
        parts = self.store.qualified(self.parts_name)
        self.spark.sql(f"ANALYZE TABLE {parts} COMPUTE STATISTICS NOSCAN")
        if scan:
            for s in self.snapshot().segments:
                self.spark.sql(f"ANALYZE TABLE {parts} PARTITION ({sql_ident(SEGMENT)} = {sql_string(s.name)}"
                               + (f", {sql_ident(self.bucket_col)}" if self.bucket_col else "") + ") COMPUTE STATISTICS")
        if columns:
            self.spark.sql(f"ANALYZE TABLE {parts} COMPUTE STATISTICS FOR ALL COLUMNS")

    def compact(self, statistics: bool = False) -> Snapshot:
        """Merge all live segments into one with files of AQE's advisory size (housekeeping)."""
        before = self.snapshot()
        if len(before.segments) < 2:
            return before
        buckets = sorted({b for s in before.segments for b in s.buckets or ()}) if self.bucket_col else None
        rows = self.read()
        merged = self.write(rows if self.bucket_col else rows.hint("rebalance"), buckets, statistics)
        if merged.rows != before.rows:
            raise RuntimeError(f"{self.name}: {merged.rows} rows after compaction, expected {before.rows}")
        return self.switch(merged, (), before.rows)

    def vacuum(self, keep: int = 2) -> list[int]:
        """Remove segments that none of the newest ``keep`` snapshots holds; return the versions whose files went.

        Also removes what lost runs left: folders and partitions of no commit.
        """
        now = self.snapshot()
        commits = self.committed().where(F.col("KIND") == COMMIT).orderBy(F.desc("VERSION")).select("LIVE").limit(max(1, keep)).collect()
        held = {(s.name, b) for r in commits for s in _segments(r.LIVE) for b in (s.buckets if s.buckets is not None else (None,))}
        names = {n for n, _ in held}
        gone: set[str] = set()
        parts = self.store.qualified(self.parts_name)
        for r in self.spark.sql(f"SHOW PARTITIONS {parts}").collect():
            spec = dict(p.split("=", 1) for p in r[0].split("/"))
            bucket = int(spec[self.bucket_col]) if self.bucket_col else None
            if (spec[SEGMENT], bucket) not in held:
                where = f"{sql_ident(SEGMENT)} = {sql_string(spec[SEGMENT])}" + (f", {sql_ident(self.bucket_col)} = {bucket}" if self.bucket_col else "")
                self.spark.sql(f"ALTER TABLE {parts} DROP IF EXISTS PARTITION ({where})")
                if self.bucket_col:
                    self.store.drop_folder(f"{self._folder(spec[SEGMENT])}/{self.bucket_col}={bucket}")
        for folder in self.store.folders(f"{self.store.root}/{self.name}"):
            m = _FOLDER.fullmatch(folder)
            if m and folder.split("=", 1)[1] not in names and int(m[1]) <= now.version:
                self.store.drop_folder(f"{self.store.root}/{self.name}/{folder}")
                gone.add(folder.split("=", 1)[1])
        for base in self.store.folders(self._keys_root):
            for folder in self.store.folders(f"{self._keys_root}/{base}"):
                m = _FOLDER.fullmatch(folder)
                if m and folder.split("=", 1)[1] not in names and int(m[1]) <= now.version:
                    self.store.drop_folder(f"{self._keys_root}/{base}/{folder}")
        self.spark.sql(f"REFRESH TABLE {parts}")
        return sorted({int(g.split("-")[0]) for g in gone})


def _kind(column: str) -> str:
    return {"n": "bigint", "lo": "string", "hi": "string", "sk": "binary"}[column.rstrip("0123456789")]


def _segments(live: str) -> tuple[Segment, ...]:
    return tuple(Segment(n, r, None if b is None else tuple(b)) for n, r, b in json.loads(live))


def _condition(segments: tuple[Segment, ...], bucket_col: str | None) -> str:
    """Partition predicate that holds for the given segments and buckets."""
    if not segments:
        return "false"
    if not bucket_col:
        return f"{sql_ident(SEGMENT)} IN ({', '.join(sql_string(s.name) for s in segments)})"
    return " OR ".join(f"({sql_ident(SEGMENT)} = {sql_string(s.name)} AND {sql_ident(bucket_col)} IN ({', '.join(map(str, s.buckets))}))"
                       for s in segments if s.buckets) or "false"
