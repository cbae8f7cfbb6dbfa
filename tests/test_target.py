"""Targets of immutable segments: appends in place, one switch, lost drivers, the ledger, statistics, early stop."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from loadwright.operators.rejects import RejectLimitExceeded
from loadwright.plans import LoadSpec, TableStore, load, run_load
from loadwright.plans.target import SEGMENT, TargetTable
from loadwright.sources import deliveries as D
from tests.test_load import COLS, RUN_TS, env, events, name, table_rows, write  # noqa: F401


def plain(table, **kw):
    return LoadSpec("src.base.acct", COLS, delimiter="|", custom_table_name=table, **kw)


def keyed(table, **kw):
    return plain(table, column_id="id", table_key="id", **kw)


def data_files(root, table):
    found = glob.glob(f"{root}/{table.upper()}/{SEGMENT}=*/**/*.parquet", recursive=True)
    return {f: (os.path.getsize(f), os.path.getmtime(f)) for f in found}


def test_append_writes_only_the_delivery(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "UPDT", "20210101-000000", [f"{i}|n{i}|{i}.5" for i in range(500)])
    run_load(spark, plain(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    first = data_files(store.root, table)
    write(inbox, "UPDT", "20210102-000000", ["7|again|1.0", "900|new|2.0"])
    report = run_load(spark, plain(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    both = data_files(store.root, table)
    assert {f: s for f, s in both.items() if f in first} == first                  # no old file was touched
    added = [f for f in both if f not in first]
    assert added and spark.read.parquet(*added).count() == 2                         # bytes written = the delivery
    assert (report.files[0].before, report.files[0].after) == (500, 502) and store.read(table).count() == 502
    snapshot = store.snapshot(table)
    assert [s.rows for s in snapshot.segments] == [500, 2] and snapshot.rows == 502


def test_update_rewrites_only_the_segments_of_its_keys(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    target = store.target(table)
    for day, lines in (("01", ["1|a|1.0", "2|b|1.0"]), ("02", ["3|c|1.0", "|null|1.0"]), ("03", ["5|e|1.0"])):
        write(inbox, "UPDT", f"202101{day}-000000", lines)
        run_load(spark, plain(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)   # no key: INST
    before = {s.name for s in target.snapshot().segments}
    write(inbox, "UPDT", "20210201-000000", ["3|cc|2.0", "9|new|2.0"])
    rep = run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, check_primary_key=False)
    kept = before & {s.name for s in target.snapshot().segments}
    assert len(before) == 3 and len(kept) == 2                                       # only the segment of key 3 went
    assert (rep.files[0].before, rep.files[0].after_delete, rep.files[0].after) == (5, 4, 6)
    assert [r[:3] for r in table_rows(store, table)] == [(1, "a", 1.0), (2, "b", 1.0), (3, "cc", 2.0), (5, "e", 1.0), (9, "new", 2.0), (None, "null", 1.0)]
    write(inbox, "UPDT", "20210202-000000", ["100|far|3.0"])                         # no key of it exists: an append
    rep = run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, check_primary_key=False)
    assert len(target.snapshot().segments) == 4 and (rep.files[0].after_delete, rep.files[0].after) == (6, 7)
    target.compact()
    assert len(target.snapshot().segments) == 1 and store.read(table).count() == 7
    assert run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True).files == []   # the ledger still knows them


class Lost(Exception):
    """Stands for a driver that dies: nothing after it runs."""


#: After the segment is written, after the ledger row, at the switch, after the switch but before the journal.
POINTS = ["write", "_record", "_point_view", "_finish"]


@pytest.mark.parametrize("kind", ["INST", "UPDT", "bulk", "buckets"])
def test_lost_driver_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, kind):
    """The driver dies at each point of a load; the next run brings the same rows as if nothing had happened."""
    from loadwright.plans import Journal

    store = TableStore(spark, str(tmp_path / "wh"))
    table, inbox = f"LOST_{kind}".upper(), tmp_path / "IN"
    spec = plain(table) if kind == "INST" else keyed(table, buckets=4 if kind == "buckets" else None)
    journal = Journal(store, prefix=f"JL_{kind}_")
    run = lambda: run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, bulk=kind == "bulk")
    write(inbox, "UPDT" if kind == "INST" else "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0", "3|c|3.0"])
    run()
    for i, point in enumerate(POINTS):
        old = table_rows(store, table)
        write(inbox, "UPDT", f"2021020{i + 1}-000000", [f"2|b{i}|20.0", f"{10 + i}|d|4.0"])
        if kind == "bulk":
            write(inbox, "UPDT", f"2021020{i + 1}-120000", [f"{10 + i}|dd|5.0", f"{20 + i}|e|5.0"])
        owner = load.GovernedLoad if point == "_finish" else TargetTable
        real = getattr(owner, point)

        def dies(self, *args, **kw):
            if point in ("write", "_record"):
                real(self, *args, **kw)              # dies right after this step
            raise Lost(point)

        with monkeypatch.context() as m:
            m.setattr(owner, point, dies)
            with pytest.raises(Lost):
                run()
        seen = table_rows(store, table)
        assert run().files == [] if point == "_finish" else run().files
        done = table_rows(store, table)
        assert seen == (done if point == "_finish" else old)                         # all old or all new, never between
        names = [r[:2] for r in done]
        assert names.count((2, f"b{i}")) == names.count((10 + i, "dd" if kind == "bulk" else "d")) == 1
        assert len(done) == {"INST": 5, "UPDT": 4, "buckets": 4, "bulk": 5}[kind] + {"INST": 2, "UPDT": 1, "buckets": 1, "bulk": 2}[kind] * i
    gone = store.vacuum(table, keep=1)
    assert table_rows(store, table) == done and all(v <= store.version(table) for v in gone)


def test_readers_keep_their_snapshot(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0"])
    run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS)
    reader = store.read(table)
    write(inbox, "FULL", "20210102-000000", ["2|b|1.0", "3|c|1.0"])
    run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS)
    assert [r.id for r in reader.collect()] == [1] and store.read(table).count() == 2


def test_one_full_of_equally_named_files_in_two_folders(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    from loadwright.plans import Journal

    for folder, value in (("a", "old"), ("b", "new")):
        write(tmp_path / "IN" / folder, "FULL", "20210101-000000", [f"1|{value}|1.0"])
    names = D.parse_delivery_names(D.list_deliveries(spark, str(tmp_path / "IN")))
    plan = D.plan_deliveries(names)
    assert plan.count() == 1 and D.unprocessed_deliveries(names, plan).count() == 1
    journal = Journal(store, prefix="JTF_")
    rep = run_load(spark, keyed("TWO_FOLDERS"), str(tmp_path / "IN"), store, journal, run_ts=RUN_TS, skip_applied=True)
    assert len(rep.files) == 1 and rep.not_processed == [name("FULL", "20210101-000000")]
    assert [r[1] for r in table_rows(store, "TWO_FOLDERS")] == ["new"]
    assert run_load(spark, keyed("TWO_FOLDERS"), str(tmp_path / "IN"), store, journal, run_ts=RUN_TS, skip_applied=True).files == []


def test_a_delivery_sent_anew_is_a_new_delivery(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "UPDT", "20210101-000000", ["1|a|1.0"])
    run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    write(inbox, "UPDT", "20210101-000000", ["1|corrected|1.0"])                     # same path, other time and size
    run_load(spark, keyed(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    assert [r[1] for r in table_rows(store, table)] == ["corrected"]


def test_very_many_names_do_not_reach_the_driver(spark, env):  # noqa: F811
    """The listing holds two deliveries to apply among very many to pass over; rows meet by joins."""
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0"])
    write(inbox, "UPDT", "20210102-000000", ["2|b|1.0"])
    real = D.list_deliveries(spark, str(inbox)).select("path", "modificationTime", "length")
    many = spark.range(200_000).select(
        F.format_string("/in/%d/SRC.BASE.ACCT.J.00.MFT.PURG.ALL.000.20200101-000000.%d", "id", "id").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"))
    listing = real.unionByName(many)
    job = load.GovernedLoad(spark, keyed(table), store, journal, RUN_TS, skip_applied=True)
    collected = []
    old = type(listing).collect
    try:
        type(listing).collect = lambda self: collected.append(out := old(self)) or out
        report = job.run_listing(listing)
        again = load.GovernedLoad(spark, keyed(table), store, journal, RUN_TS, skip_applied=True).run_listing(listing)
    finally:
        type(listing).collect = old
    assert max(map(len, collected)) <= load.LISTED_NAMES + 1
    assert len(report.files) == 2 and len(report.not_processed) == load.LISTED_NAMES and again.files == [] and again.not_processed == []
    passed = journal.events(report.run_id).where("SD_EVENT = 'File_Not_Processed'")
    assert passed.count() == 200_000 == passed.select("SD_ID").distinct().count()
    later = journal.events(report.run_id).where("SD_EVENT = 'Input_file'").agg(F.min("SD_ID")).first()[0]
    assert later > passed.agg(F.max("SD_ID")).first()[0]


def test_column_statistics_merge(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    for buckets in (None, 4):
        t = f"{table}_{buckets}"
        spec = keyed(t, buckets=buckets, column_stats=True)
        folder = inbox / str(buckets)
        write(folder, "FULL", "20210101-000000", [f"{i}|n{i % 700}|{i / 4}" for i in range(-20, 3000)])
        run_load(spark, spec, str(folder), store, journal, run_ts=RUN_TS)
        late = inbox / f"{buckets}_2"
        write(late, "UPDT", "20210102-000000", ["-20||5.5", "2999|zz|", "5000|zzz|9999.5"])
        run_load(spark, spec, str(late), store, journal, run_ts=RUN_TS)
        target = store.target(t)
        got = {r.column_name: r for r in target.column_statistics().collect()}
        rows = store.read(t)
        for c, kind in (("id", int), ("name", str), ("amount", float)):
            exact = rows.agg(F.count_if(F.col(c).isNull()).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_distinct(c).alias("d")).first()
            r = got[c]
            assert (r.n_rows, r.n_null, kind(r.min_value), kind(r.max_value)) == (3021, exact.n, exact.lo, exact.hi)
            assert abs(r.n_distinct / exact.d - 1) < 0.05
        target.compact(statistics=True)
        assert {r.column_name: r.n_null for r in target.column_statistics().collect()}["name"] == 1


@pytest.mark.parametrize("bad,fails", [(49, False), (50, True), (51, True)])
def test_reject_limit_while_parsing_keeps_its_boundary(spark, env, monkeypatch, bad, fails):  # noqa: F811
    monkeypatch.setattr(load, "EARLY_BYTES", 1)
    monkeypatch.setattr(load, "HEAD_LINES", 20)
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["HEAD"] + [f"{i}|a|x" for i in range(bad)] + [f"{i}|a|1.0" for i in range(60)])
    run = lambda: run_load(spark, plain(table, threshold=50, skip=1), str(inbox), store, journal, run_ts=RUN_TS)
    if not fails:
        assert run().files[0].n_rejected == bad
        return
    with pytest.raises(RejectLimitExceeded):
        run()
    assert store.version(table) == 0 and ("ERROR", "NBRows_rejected too big") in events(journal, 1)


def test_a_wrong_file_fails_after_a_bounded_read(spark, env, monkeypatch):  # noqa: F811
    """200,000 rejects in many splits, a limit of 1,000: a few tasks tell, and nothing is staged."""
    monkeypatch.setattr(load, "EARLY_BYTES", 1 << 20)
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", [f"{i}|wrong|not a number {i}" for i in range(200_000)])
    key, sc = "spark.sql.files.maxPartitionBytes", spark.sparkContext
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        spec = plain(table, threshold=1000)
        sc.setJobGroup("bounded", "early stop")
        assert load.reaches_reject_limit(spark, spec, str(inbox), 1000)
        jobs = sc.statusTracker().getJobIdsForGroup("bounded")
        tasks = sum(sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds)
        sc.setLocalProperty("spark.jobGroup.id", None)
        splits = spark.read.text(str(inbox)).rdd.getNumPartitions()
        assert splits > 50 and tasks <= 5
        with pytest.raises(RejectLimitExceeded):
            run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    finally:
        spark.conf.set(key, before)
    assert not glob.glob(f"{store.root}/_stage/*/run=*")
    assert 0 < store.read(spec.rejected_table_name).count() <= load.HEAD_LINES
    assert ("NBRows_rejected_table", "1000") in events(journal, 1)
