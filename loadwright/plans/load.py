"""The governed load: every delivery of an input folder applied to one target.

Per delivery, in order:
  1. list and plan the deliveries (newest FULL, later UPDTs), leaving out those
     that the target's ledger holds, with ``skip_applied``
  2. parse the text once and write it as the staging Parquet; the input,
     good, rejected, discarded and heading-line counts are observed during
     that single write; a large file that is mostly rejects fails before it is
     staged (see :func:`reaches_reject_limit`)
  3. append the rejected lines to ``<TABLE>_REJECTED``; fail at the reject limit
  4. run the custom SELECT steps on the staged good rows
  5. duplicate-key gate on the delivery key (one aggregate, also in FULL)
  6. stamp the audit columns, project, and write a new segment of the target:
     FULL the stage, INST the stage beside all segments there are, UPDT the
     stage with the surviving rows of the segments (or buckets) that hold one of
     its keys (kept-row and total counts observed on the write)
  7. primary-key check, before anything is written where that is possible
  8. reconcile counts and switch the table: rows and the delivery's ledger entry
     take effect in one catalog call (see :mod:`loadwright.plans.target`)
Table statistics are gathered once at the end of the run.
Each step's counts go to the run journal.

Every data step is a Spark job over the whole delivery and the part of the
target that it touches; the driver only handles counts, the deliveries to apply
and the names of segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.keys import BUCKET_COLUMN, all_keys_present, any_key_null, bucket_of
from loadwright.functions.tokens import as_struct
from loadwright.functions.names import MODE_FULL, MODE_INSERT, MODE_UPDATE
from loadwright.operators import keys as keys_mod
from loadwright.operators import modes as modes_mod
from loadwright.operators import rejects as rejects_mod
from loadwright.operators import transform as tf
from loadwright.operators.counts import ReconciliationError, reconcile
from loadwright.plans.journal import Journal, now_ts
from loadwright.plans.spec import LoadSpec
from loadwright.plans.store import TableStore
from loadwright.plans.target import IDENTITY, SEGMENT, Delivery, Segment
from loadwright.sources import deliveries as dl
from loadwright.sources import textscan as ts


#: Names of deliveries passed over that a report lists; all of them are in the journal and the ledger.
LISTED_NAMES = 1000


class PrimaryKeyViolation(RuntimeError):
    pass


@dataclass
class FileReport:
    file_name: str
    load_mode: str
    effective_mode: str
    n_lines: int = 0
    n_headings: int = 0
    n_good: int = 0
    n_rejected: int = 0
    n_discarded: int = 0
    stage_rows: int = 0
    null_key_rows: int | None = None    # staged rows with a NULL key part (from the duplicate gate)
    key_bytes: int | None = None
    before: int = 0
    after_delete: int | None = None
    after: int = 0


@dataclass
class LoadReport:
    run_id: int
    table: str
    files: list[FileReport] = field(default_factory=list)
    not_processed: list[str] = field(default_factory=list)   # the first LISTED_NAMES by name


def _parsed(spec: LoadSpec, lines: DataFrame) -> DataFrame:
    if spec.delimiter:
        return ts.parse_delimited(lines, spec.parse_schema, spec.delimiter, spec.pad_short_rows, formats=spec.formats)
    return ts.parse_fixed_width(lines, spec.parse_schema, spec.widths, formats=spec.formats)


_POSITION = (ts.FILE, ts.BLOCK, ts.ROW_ID)


def parse_delivery(spark: SparkSession, spec: LoadSpec, path: str) -> DataFrame:
    """All lines of one delivery, classified by their content; with their position if headings are to be found among them."""
    lines = ts.read_lines(spark, path, with_position=spec.skip > 0, line_sep=spec.line_sep)
    parsed = _parsed(spec, lines)
    keep = [c for c in parsed.columns if c not in (ts.STATUS, ts.LINE, ts.REASON)]
    # the whole line is kept only where the rejected table needs it: a staged
    # good row already holds its values, and storing its text too would double
    # the stage written and read for every delivery
    line = F.when(F.col(ts.STATUS) == F.lit(ts.REJECTED), F.col(ts.LINE))
    return parsed.select(*keep, line.alias(ts.LINE), ts.STATUS)


def without_headings(staged: DataFrame, skip: int) -> DataFrame:
    """The written lines of a delivery with its heading lines classified as ``skipped``."""
    status = F.when(F.col(ts.HEADING), F.lit(ts.SKIPPED)).otherwise(F.col(ts.STATUS))
    flagged = ts.flag_headings(staged, skip)
    return flagged.select(*(c for c in staged.columns if c not in (*_POSITION, ts.STATUS)), status.alias(ts.STATUS))


#: A delivery of so many bytes is looked at before it is staged ..
EARLY_BYTES = 64 << 20
#: .. by so many lines of its head; and the most rejects that are counted ahead.
HEAD_LINES = 10_000
EARLY_REJECTS = 5_000_000


def head_lines(spark: SparkSession, spec: LoadSpec, path: str) -> DataFrame:
    """The first lines of a delivery (``HEAD_LINES`` at most, a bounded sample that passes through the driver), classified."""
    lines = ts.read_lines(spark, path, line_sep=spec.line_sep).head(HEAD_LINES)
    return _parsed(spec, spark.createDataFrame([(r["value"],) for r in lines], "value string").coalesce(1))


def reaches_reject_limit(spark: SparkSession, spec: LoadSpec, path: str, limit: int, n_files: int = 1) -> bool:
    """Does a delivery hold at least ``limit`` rejects (its headings not counted)?  Reads no more than it takes to tell.

    A limit at the root of a plan runs in rounds of growing numbers of splits
    and ends as soon as it is met, within a split too.  Headings may look like
    rejects, so as many more are asked for; a delivery that has fewer is left to
    the count over all of it.
    """
    lines = ts.read_lines(spark, path, line_sep=spec.line_sep)
    rejects = _parsed(spec, lines).where(F.col(ts.STATUS) == ts.REJECTED).select(F.lit(1).alias("one"))
    return bool(rejects.offset(limit + spec.skip * n_files - 1).limit(1).collect())


def _status_counts():
    s = F.col(ts.STATUS)
    return [F.count(F.lit(1)).alias("n_lines"),
            F.count_if(s == ts.SKIPPED).alias("n_headings"),
            F.count_if(s == ts.GOOD).alias("n_good"),
            F.count_if(s == ts.REJECTED).alias("n_rejected"),
            F.count_if(s == ts.DISCARDED).alias("n_discarded")]


class GovernedLoad:
    def __init__(self, spark: SparkSession, spec: LoadSpec, store: TableStore,
                 journal: Journal | None = None, run_ts: str | None = None,
                 process: str = "GOVERNED_LOAD", check_primary_key: bool = True, bulk: bool = False,
                 skip_applied: bool = False):
        self.spark, self.spec, self.store = spark, spec, store
        self.journal = journal or Journal(store)
        self.run_ts = run_ts or now_ts()
        self.process = process
        self.check_primary_key = check_primary_key
        self.bulk = bulk
        # the original moved each processed file out of its input folder; with
        # ``skip_applied`` the target's ledger plays that part: deliveries (path,
        # time, size) that it shows as applied or passed over are left out
        self.skip_applied = skip_applied
        self.table = spec.table_name
        self.target = store.target(self.table)

    # -- journal shortcuts -------------------------------------------------
    def _ev(self, name: str, value="") -> None:
        self.journal.event(self.run_id, name, value, self.run_ts)

    def run(self, in_folder: str) -> LoadReport:
        return self.run_listing(dl.list_deliveries(self.spark, in_folder))

    def run_listing(self, listing: DataFrame) -> LoadReport:
        """Apply the deliveries of a listing (``path`` column, see ``list_deliveries``)."""
        self.journal.ensure()
        self.run_id = self.journal.open_run(self.process, self.spec.object_name, self.run_ts)
        report = LoadReport(self.run_id, self.table)
        self._ev("Dataloader", "Begin")
        try:
            if self.target.ensure(self.spec.stored_schema, BUCKET_COLUMN if self.spec.buckets else None):
                self._ev("Table_Creation", self.table)
            if self.spec.key_index:
                self.target.declare_key_index(self.spec.table_key, self.spec.column_id)
            names = dl.parse_delivery_names(listing.select("path", *(c for c in (*IDENTITY[1:], "n_files") if c in listing.columns)))
            if self.skip_applied:
                names = self._unseen(names)
            plan = dl.plan_deliveries(names, keys=self.spec.column_id)
            self._pass_over(names, plan, report)
            self.journal.flush()
            before = self.target.snapshot().rows
            self.rejected_in_run = 0
            self.changed = False
            items = dl.plan_list(plan)
            if self.bulk and len(items) > 1:
                report.files.extend(self._bulk(items, before))
                self.journal.flush()
            else:
                for i, item in enumerate(items):
                    fr = self._one(i, item, before)
                    report.files.append(fr)
                    before = fr.after
                    self.journal.flush()
            if self.changed and self.spec.analyze:
                # statistics once per run: they only serve later queries
                self.target.analyze(scan=self.spec.analyze_scan)
                self._ev("Statistics_Calculation", "")
            self._ev("Dataloader", "End")
            self.journal.flush()
            self.journal.close_run(self.run_id, self.run_ts)
            if items and not self.spec.keep_stage:
                self.store.drop_folder(f"{self.store.root}/_stage/{self.table}/run={self.run_id}")
            return report
        except Exception as exc:
            self._ev("ERROR", str(exc))
            self.journal.flush()
            raise

    def _unseen(self, names: DataFrame) -> DataFrame:
        """The deliveries that the target's ledger does not hold yet."""
        keys = [c for c in IDENTITY if c in names.columns]
        seen = self.target.retired().select(*(F.col(c).alias(f"seen_{c}") for c in keys)).distinct()
        same = reduce(lambda a, b: a & b, [names[c].eqNullSafe(seen[f"seen_{c}"]) for c in keys])
        return names.join(seen, same, "left_anti")

    def _pass_over(self, names: DataFrame, plan: DataFrame, report: LoadReport) -> None:
        """Log and retire the deliveries outside the plan, before anything is applied: a run that fails half-way retires them too.

        A few are listed in the report; more are written by Spark without reaching the driver.
        """
        left = dl.unprocessed_deliveries(names, plan)
        some = left.limit(LISTED_NAMES + 1).collect()
        if not some:
            return
        if len(some) > LISTED_NAMES:
            self.journal.append_events(self.run_id, "File_Not_Processed", left.select("file_name"), self.run_ts)
            report.not_processed = [r["file_name"] for r in left.orderBy("file_name", "path").select("file_name").limit(LISTED_NAMES).collect()]
        else:
            left = self.spark.createDataFrame(some, left.schema).coalesce(1)
            report.not_processed = sorted(r["file_name"] for r in some)
            for name in report.not_processed:
                self._ev("File_Not_Processed", name)
        self.target.pass_over(left, self.run_id)

    def _one(self, index: int, item: dict, before: int) -> FileReport:
        fr, stamped = self._stage(index, item, before)
        self._apply(index, item, fr, stamped, before)
        return fr

    @staticmethod
    def _delivery(item: dict, fr: FileReport) -> Delivery:
        return Delivery(item["path"], item["file_name"], item.get("modificationTime"), item.get("length"), item["load_mode"], item["file_date"], fr.stage_rows)

    def _stage(self, index: int, item: dict, before: int | None):
        """Steps 2-5 for one delivery: the gated, stamped stage and its report.

        ``before`` is None in a bulk load, which knows it only after all files are staged.
        """
        spec, store = self.spec, self.store
        mode = item["load_mode"]
        eff = modes_mod.effective_mode(mode, spec.column_id)
        fr = FileReport(item["file_name"], mode, eff, before=before or 0)
        self._ev("Input_file", item["file_name"])

        self._stop_early(item)
        # 2. parse once into the staging Parquet, counting while writing
        stage_path = f"{store.root}/_stage/{self.table}/run={self.run_id}/delivery={index:04d}"
        obs = Observation(f"parse_{self.run_id}_{index}")
        parse_delivery(self.spark, spec, item["path"]).observe(obs, *_status_counts()).write.parquet(stage_path)
        c, staged = obs.get, self.spark.read.parquet(stage_path)
        if spec.skip:
            staged = without_headings(staged, spec.skip)
            c = staged.agg(*_status_counts()).first()
        fr.n_lines, fr.n_headings, fr.n_good = c["n_lines"], c["n_headings"], c["n_good"]
        fr.n_rejected, fr.n_discarded = c["n_rejected"], c["n_discarded"]
        self._ev("NB_Rows_input_file", fr.n_lines)
        if before is not None:
            self._ev("NBRows_before_loading", before)
        self._ev("Loadmode", mode)
        if mode == MODE_UPDATE and eff == MODE_INSERT:
            self._ev("New_Loadmode", MODE_INSERT)
        if eff == MODE_UPDATE and spec.keys_differ:
            self._ev("WARNING", "UPDT : COLUMN_ID != TABLE_KEY")

        # 3. rejects and the reject limit (counted over the whole run)
        if fr.n_rejected:
            self._ev("NB_Rows_bad_file", fr.n_rejected)
            store.ensure_append(spec.rejected_table_name, rejects_mod.REJECTED_SCHEMA)
            store.append(spec.rejected_table_name, rejects_mod.rejected_rows(staged, self.run_id, self.run_ts))
            # rejects of this run so far: known from the parse observations, no re-count
            self.rejected_in_run += fr.n_rejected
            n_run = self.rejected_in_run
            self._ev("NBRows_rejected_table", n_run)
            gate = rejects_mod.reject_gate(n_run, spec.threshold, raise_on_fail=False)
            if not gate.passed:
                self._ev("ERROR", "NBRows_rejected too big")
                rejects_mod.reject_gate(n_run, spec.threshold)
        if fr.n_discarded:
            self._ev("NB_Rows_discard_file", fr.n_discarded)

        # 4. custom steps, 5. duplicate-key gate
        stage = ts.good_rows(staged, spec.parse_schema)
        if spec.steps:
            # the steps' result is staged once: gate, guard and write read it instead of running them again
            done = f"{store.root}/_stage/{self.table}/run={self.run_id}/steps={index:04d}"
            tf.apply_steps(self.spark, stage, spec.steps).write.parquet(done)
            stage = self.spark.read.parquet(done)
        if spec.column_id:
            gate = keys_mod.assert_unique(stage, spec.column_id, raise_on_fail=False)
            fr.stage_rows, fr.null_key_rows, fr.key_bytes = gate.n_rows, gate.n_null_rows, gate.key_bytes
            self._ev("NBRows_temp_table", fr.stage_rows)
            if not gate.passed:
                raise keys_mod.DuplicateKeys(
                    f"Duplicate keys present in the delivery {fr.file_name}: {gate.n_dup_keys} keys")
        else:
            fr.stage_rows = stage.count() if spec.steps else fr.n_good
            self._ev("NBRows_temp_table", fr.stage_rows)

        # 6. audit columns and projection
        stamped = tf.project(tf.stamp_audit(stage, item["file_date"], self.run_ts), spec.select)
        return fr, stamped

    def _stop_early(self, item: dict) -> None:
        """Refuse a large delivery that is mostly rejects before it is parsed as a whole.

        The head decides whether the rejects are counted ahead, so a good file
        costs one small read more.  The rejected lines of the head are kept.
        """
        left = self.spec.threshold - self.rejected_in_run
        if (item.get("length") or 0) < EARLY_BYTES or not 0 < left <= EARLY_REJECTS:
            return
        head = head_lines(self.spark, self.spec, item["path"])
        seen = ts.line_counts(head).first()
        if 2 * seen["n_rejected"] < seen["n_lines"]:
            return
        if not reaches_reject_limit(self.spark, self.spec, item["path"], left, item.get("n_files") or 1):
            return
        self._ev("NB_Rows_bad_file", left)
        self.store.ensure_append(self.spec.rejected_table_name, rejects_mod.REJECTED_SCHEMA)
        self.store.append(self.spec.rejected_table_name, rejects_mod.rejected_rows(head, self.run_id, self.run_ts))
        self._ev("NBRows_rejected_table", self.spec.threshold)
        self._ev("ERROR", "NBRows_rejected too big")
        rejects_mod.reject_gate(self.spec.threshold, self.spec.threshold)

    def _apply(self, index: int, item: dict, fr: FileReport, stamped: DataFrame, before: int) -> None:
        """Steps 6-8 for one delivery: new segment by mode, reconcile, switch."""
        eff, snapshot = fr.effective_mode, self.target.snapshot()
        stamped = self._conform(stamped, self.target.read())
        keys, keep, kept, old_rows, buckets = self.spec.column_id, (), None, 0, None
        if self.spec.buckets:
            buckets = self._buckets([stamped])
        if eff == MODE_FULL:
            self._ev("NBRows_table_after_truncate", 0)
            self._pk_guard(stamped, eff, fr)
        elif eff == MODE_UPDATE:
            self._pk_guard(stamped, eff, fr)
            touched, keep, old_rows = self._touched(snapshot, [stamped], fr.key_bytes, buckets)
            if touched:
                kept = Observation(f"kept_{self.run_id}_{index}")
                survivors = keys_mod.anti_by_key(self.target.rows_of(touched), stamped, keys, fr.key_bytes)
                stamped = survivors.observe(kept, F.count(F.lit(1)).alias("rows")).unionByName(stamped)
        else:
            self._pk_guard(stamped, eff, fr)
            keep = snapshot.segments

        segment = self.target.write(stamped, buckets, self.spec.column_stats)
        if eff == MODE_FULL:
            fr.after = segment.rows
            reconcile(MODE_FULL, before, fr.stage_rows, fr.after)
        elif eff == MODE_UPDATE:
            removed = old_rows - int(kept.get["rows"]) if kept else 0
            fr.after, fr.after_delete = before - old_rows + segment.rows, before - removed
            reconcile(MODE_UPDATE, before, fr.stage_rows, fr.after, removed=removed)
        else:
            fr.after = before + segment.rows
            reconcile(MODE_INSERT, before, fr.stage_rows, fr.after)
        self.target.switch(segment, keep, fr.after, [self._delivery(item, fr)], self.run_id)
        if eff == MODE_FULL:
            self._ev("NBRows_table_after_loading=NBRows_temp_table", "")
        elif eff == MODE_UPDATE:
            self._ev("NBRows_table_after_delete_request", fr.after_delete)
        self._finish(fr.after)

    def _buckets(self, stages: list[DataFrame]) -> list[int]:
        """The buckets that staged keys fall in (at most ``spec.buckets`` small numbers)."""
        touched = reduce(DataFrame.unionByName, [st.select(BUCKET_COLUMN) for st in stages]).distinct()
        return sorted(r[0] for r in touched.collect())

    def _touched(self, snapshot, stages: list[DataFrame], key_bytes: int | None,
                 buckets: list[int] | None) -> tuple[tuple[Segment, ...], tuple[Segment, ...], int]:
        """(segments or buckets to rewrite, those to keep as they are, rows of the former).

        Without buckets these are the segments in which some staged key occurs:
        one scan of the key columns, and only names of segments reach the driver.
        """
        if buckets is not None:
            touched, keep = snapshot.split_buckets(set(buckets))
            return touched, keep, self.target.parts(touched).count() if touched else 0      # pruned to the touched buckets
        touched = snapshot.segments
        if len(touched) > 1:
            keys = self.spec.column_id
            staged = keys_mod.staged_keys(reduce(DataFrame.unionByName, [st.select(*keys) for st in stages]), keys, key_bytes)
            hit = self.target.parts(touched).select(SEGMENT, *keys).join(staged, keys, "left_semi").select(SEGMENT).distinct()
            names = {r[0] for r in hit.collect()}
            touched = tuple(s for s in touched if s.name in names)
        return touched, snapshot.without({s.name for s in touched}), sum(s.rows for s in touched)

    def _finish(self, after: int) -> None:
        self._ev("NBRows_after_loading", after)
        self.changed = True

    @property
    def _key_gate_covers_pk(self) -> bool:
        """True when the duplicate gate has already proven the staged primary keys unique.

        That holds when the primary key is the delivery key and the staged key
        values reach the target unchanged: no custom projection, and each key
        column parsed with its target type (a cast could merge distinct keys).
        """
        spec = self.spec
        if not spec.column_id or spec.table_key != spec.column_id:
            return False
        if spec.select not in (None, [], "*", ["*"]):
            return False
        parsed, declared = spec.parse_schema, as_struct(spec.columns)
        return all(k in parsed.fieldNames() and k in declared.fieldNames()
                   and parsed[k].dataType == declared[k].dataType for k in spec.table_key)

    def _conform(self, stamped: DataFrame, target: DataFrame) -> DataFrame:
        if self.spec.buckets:
            stamped = stamped.withColumn(BUCKET_COLUMN, bucket_of(self.spec.column_id, self.spec.buckets))
        return modes_mod.conform(stamped, target)

    def _pk_guard(self, stage: DataFrame, mode: str, fr: FileReport) -> None:
        """Refuse a delivery that would break the primary key, before anything is written.

        The current snapshot already satisfies the key (every switch is guarded
        and a table starts empty), so only the staged rows can add a violation:
        a NULL or repeated key among them, or a key also held by a surviving row
        (of the kept rows of an UPDT, of the whole target for INST).  When
        the primary key is the delivery key, the duplicate gate and the delete
        by key already rule the second case out.  Of the surviving rows only
        key columns are read: with a key index those in the buckets of staged
        keys, without one all of them.
        """
        tk = self.spec.table_key
        if not (self.check_primary_key and tk):
            return
        if self._key_gate_covers_pk:
            # the duplicate gate already grouped these very key values: only NULLs are left to
            # find, and the gate counted them in the same aggregate
            broken = fr.null_key_rows if fr.null_key_rows is not None else (
                stage.where(any_key_null(tk)).limit(1).count())
        else:
            broken = keys_mod.pk_violations(stage.select(*tk), tk).limit(1).count()
        if broken:
            raise PrimaryKeyViolation(f"the delivery breaks the key {tk} of {self.table}")
        if mode == MODE_FULL or (mode == MODE_UPDATE and tk == self.spec.column_id):
            return
        if self._held(stage, self.target.snapshot().segments, fr.key_bytes if mode == MODE_UPDATE else None, mode == MODE_UPDATE).limit(1).count():
            raise PrimaryKeyViolation(f"the delivery repeats keys {tk} already in {self.table}")

    def _held(self, stage: DataFrame, segments: tuple[Segment, ...], key_bytes: int | None = None, deleting: bool = False) -> DataFrame:
        """Rows of ``segments`` with a staged primary key; ``deleting``: without those that the delivery key deletes."""
        tk, keys = self.spec.table_key, self.spec.column_id if deleting else []
        held = self.target.key_rows(segments, stage, tk, keys).join(keys_mod.staged_keys(stage, tk), tk, "left_semi")
        return keys_mod.anti_by_key(held, stage, keys, key_bytes) if deleting else held

    def _bulk(self, plan: list[dict], before: int) -> list[FileReport]:
        """Stage and gate every planned delivery, then write one merged segment.

        Equivalent to applying the deliveries one by one (see
        ``operators.modes.merge_deliveries``) but what they touch is rewritten
        once instead of once per delivery.  The rows that each file in turn would
        remove are counted from the keys, and the target must hold what these
        counts add up to before it is switched.
        """
        staged = [self._stage(i, item, None) for i, item in enumerate(plan)]
        target, snapshot, keys = self.target.read(), self.target.snapshot(), self.spec.column_id
        deliveries = [(fr.effective_mode, self._conform(st, target)) for fr, st in staged]
        stages = [st for _, st in deliveries]
        same_key = self.spec.table_key == keys
        if same_key:
            # one winner per key: each delivery's own NULL/duplicate keys are all that can break it
            for (fr, _), st in zip(staged, stages):
                self._pk_guard(st, MODE_FULL, fr)
        reports = [fr for fr, _ in staged]
        known = [fr.key_bytes for fr in reports]
        key_bytes = None if None in known else sum(known)
        expected = self._count_in_turn(reports, target, deliveries, before)

        modes = [mode for mode, _ in deliveries]
        buckets = self._buckets(stages) if self.spec.buckets else None
        if modes[0] == MODE_FULL:
            touched, keep, old_rows = snapshot.segments, (), before
            new = modes_mod.merge_deliveries(target, deliveries, keys, key_bytes)      # the target is not read
        elif MODE_UPDATE in modes:
            touched, keep, old_rows = self._touched(snapshot, stages, key_bytes, buckets)
            old = self.target.rows_of(touched) if touched else target.limit(0)
            new = modes_mod.merge_deliveries(old, deliveries, keys, key_bytes)
        else:
            touched, keep, old_rows = (), snapshot.segments, 0
            new = reduce(DataFrame.unionByName, stages)
        segment = self.target.write(new, buckets, self.spec.column_stats)
        if self.check_primary_key and self.spec.table_key and not same_key:
            self._pk_check(segment, keep)
        after = before - old_rows + segment.rows
        reconcile(MODE_FULL, before, expected, after)
        self.target.switch(segment, keep, after, [self._delivery(i, fr) for i, fr in zip(plan, reports)], self.run_id)
        for fr in reports:  # in the order of their Input_file events
            self._ev("NBRows_before_loading", fr.before)
            if fr.effective_mode == MODE_FULL:
                self._ev("NBRows_table_after_truncate", 0)
                self._ev("NBRows_table_after_loading=NBRows_temp_table", "")
            elif fr.after_delete is not None:
                self._ev("NBRows_table_after_delete_request", fr.after_delete)
            self._finish(fr.after)
        return reports

    def _count_in_turn(self, reports: list[FileReport], target: DataFrame, deliveries: list, before: int) -> int:
        """Fills in each file's counts as if it were applied alone, in order; returns the final count.

        A row goes when a later file holds its key.  One aggregate gives the
        files that hold each key (at most one row per key and file: the gate
        saw to that); a target row goes with the first of them.  Only counts
        per pair of files reach the driver.
        """
        keys = self.spec.column_id
        gone: dict[int, int] = {}
        if keys and any(mode == MODE_UPDATE for mode, _ in deliveries):
            keyed = reduce(DataFrame.unionByName, [st.select(*keys, F.lit(i).alias("_ord")) for i, (_, st) in enumerate(deliveries)])
            held = keyed.where(all_keys_present(keys)).groupBy(*keys).agg(F.sort_array(F.collect_set("_ord")).alias("_held"))
            later = held.select(F.explode(F.slice("_held", 2, len(deliveries))).alias("at"))
            if deliveries[0][0] != MODE_FULL:
                first = target.select(*keys).join(held.select(*keys, F.get("_held", F.lit(0)).alias("at")), keys).select("at")
                later = later.unionByName(first)
            gone = {r["at"]: r["count"] for r in later.groupBy("at").count().collect()}
        rows = before
        for i, fr in enumerate(reports):
            fr.before = rows
            if fr.effective_mode == MODE_FULL:
                fr.after_delete, rows = None, 0
            elif fr.effective_mode == MODE_UPDATE:
                rows -= gone.get(i, 0)
                fr.after_delete = rows
            rows += fr.stage_rows
            fr.after = rows
        return rows

    def _pk_check(self, segment: Segment, keep: tuple[Segment, ...]) -> None:
        """Primary-key test of a written segment, and against the kept ones, which satisfy the key among themselves."""
        keys = self.spec.table_key
        written = self.target.written(segment)
        if keys_mod.pk_violations(written.select(*keys), keys).limit(1).count() or (
                keep and self._held(written, keep).limit(1).count()):
            raise PrimaryKeyViolation(f"the new snapshot of {self.table} breaks the key {keys}")


def run_load(spark: SparkSession, spec: LoadSpec, in_folder: str, store: TableStore,
             journal: Journal | None = None, run_ts: str | None = None, **kw) -> LoadReport:
    """Apply the deliveries found in ``in_folder`` to the target of ``spec``."""
    return GovernedLoad(spark, spec, store, journal, run_ts, **kw).run(in_folder)


__all__ = ["run_load", "GovernedLoad", "LoadReport", "FileReport", "parse_delivery",
           "PrimaryKeyViolation", "ReconciliationError"]
