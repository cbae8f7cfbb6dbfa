import pytest
from pyspark.sql import functions as F

from loadwright.operators.keys import DuplicateKeys
from loadwright.operators.rejects import RejectLimitExceeded
from loadwright.plans import Journal, LoadSpec, TableStore, run_load
from loadwright.plans.load import PrimaryKeyViolation

COLS = "id BIGINT, name STRING, amount DOUBLE"
RUN_TS = "2021-05-01 10:00:00"


def name(mode, date):
    return f"SRC.BASE.ACCT.J.00.MFT.{mode}.ALL.000.{date}.{date}"


@pytest.fixture
def env(spark, tmp_path, request):
    suffix = request.node.name.replace("[", "_").replace("]", "").replace("-", "_")[-40:]
    store = TableStore(spark, str(tmp_path / "wh"))
    return store, Journal(store, prefix=f"J_{suffix}_"), f"ACCT_{suffix}", tmp_path / "IN"


def write(folder, mode, date, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name(mode, date)).write_text("".join(line + "\n" for line in lines))


def table_rows(store, table):
    return sorted(((r.id, r.name, r.amount, str(r.METADATA_TM_FILE)) for r in store.read(table).collect()),
                  key=lambda t: (t[0] is None, str(t)))


def events(journal, run_id):
    return [(r.SD_EVENT, r.SD_EVENT_VALUE) for r in journal.events(run_id).orderBy("SD_ID").collect()]


def test_full_then_update_with_rejects_and_journal(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0", "3|c|3.0"])
    write(inbox, "UPDT", "20201231-000000", ["1|old|0.0"])                 # older than FULL: skipped
    write(inbox, "UPDT", "20210102-000000", ["2|bb|20.0", "4|d|4.0", "5|e|x", "", "6|f|1|9"])
    write(inbox, "DELT", "20210103-000000", ["9|z|9.0"])                    # unknown mode
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                    custom_table_name=table)
    report = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    assert table_rows(store, table) == [
        (1, "a", 1.0, "2021-01-01 00:00:00"), (2, "bb", 20.0, "2021-01-02 00:00:00"),
        (3, "c", 3.0, "2021-01-01 00:00:00"), (4, "d", 4.0, "2021-01-02 00:00:00")]
    f1, f2 = report.files
    assert (f1.effective_mode, f1.stage_rows, f1.after) == ("FULL", 3, 3)
    assert (f2.n_lines, f2.n_good, f2.n_rejected, f2.n_discarded) == (5, 2, 2, 1)
    assert (f2.before, f2.after_delete, f2.after) == (3, 2, 4)
    assert sorted(report.not_processed) == sorted([name("UPDT", "20201231-000000"), name("DELT", "20210103-000000")])
    ev = events(journal, report.run_id)
    names = [e for e, _ in ev]
    assert names[0] == "Dataloader" and ev[-1] == ("Dataloader", "End")
    for expected in ["Table_Creation", "Input_file", "NB_Rows_input_file", "NBRows_before_loading", "Loadmode",
                     "NB_Rows_bad_file", "NBRows_rejected_table", "NB_Rows_discard_file", "NBRows_temp_table",
                     "NBRows_table_after_truncate", "NBRows_table_after_loading=NBRows_temp_table",
                     "NBRows_table_after_delete_request", "Statistics_Calculation", "NBRows_after_loading",
                     "File_Not_Processed"]:
        assert expected in names, expected
    rejected = store.read(spec.rejected_table_name).collect()
    assert sorted(r.LINE for r in rejected) == ["5|e|x", "6|f|1|9"] and {r.S_ID for r in rejected} == {report.run_id}
    st = journal.status().where(F.col("S_ID") == report.run_id).first()
    assert st.S_STATUS == 1


def test_reject_limit_keeps_previous_version(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|x", "3|c|y"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", threshold=2, custom_table_name=table)
    with pytest.raises(RejectLimitExceeded):
        run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    assert store.read(table).count() == 0 and store.version(table) == 0
    st = journal.status().orderBy(F.col("S_ID").desc()).first()
    assert st.S_STATUS == 0                         # a failed run stays open
    assert ("ERROR", "NBRows_rejected too big") in events(journal, st.S_ID)


def test_duplicate_gate_and_inst_without_keys(spark, env):
    store, journal, table, inbox = env
    write(inbox, "UPDT", "20210101-000000", ["1|a|1.0", "1|b|2.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=table)
    with pytest.raises(DuplicateKeys):
        run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    spec2 = LoadSpec("src.base.acct", COLS, delimiter="|", custom_table_name=table)
    rep = run_load(spark, spec2, str(inbox), store, journal, run_ts=RUN_TS)
    assert rep.files[0].effective_mode == "INST" and store.read(table).count() == 2
    assert ("New_Loadmode", "INST") in events(journal, rep.run_id)


def test_primary_key_check_blocks_switch(spark, env):
    store, journal, table, inbox = env
    write(inbox, "UPDT", "20210101-000000", ["1|a|1.0", "|b|2.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", table_key="id", custom_table_name=table)
    with pytest.raises(PrimaryKeyViolation):
        run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    assert store.version(table) == 0


def test_fixed_width_with_headings_steps_and_projection(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000",
          ["HEADER", "id  name      amount", "1   äpfel     10.5", "2   birnen    3", "3   kiwi      7"])
    spec = LoadSpec("src.base.acct", "id BIGINT, name STRING, total DOUBLE",
                    stage_columns="id BIGINT, name STRING, amount DOUBLE", widths="4,10,6", skip=2,
                    steps=["SELECT * FROM [TABLE] WHERE amount > 5"],
                    select=["id", "upper(name) AS name", "amount * 2 AS total"],
                    custom_table_name=table)
    rep = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    got = sorted((r.id, r.name, r.total) for r in store.read(table).collect())
    assert got == [(1, "ÄPFEL", 21.0), (3, "KIWI", 14.0)]
    assert rep.files[0].n_headings == 2 and rep.files[0].n_lines == 5 and rep.files[0].stage_rows == 2


def test_empty_inbox(spark, env):
    store, journal, table, inbox = env
    inbox.mkdir(parents=True)
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", custom_table_name=table)
    rep = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    assert rep.files == [] and rep.not_processed == [] and store.read(table).count() == 0


def test_bulk_merge_equals_per_delivery_loads(spark, tmp_path):
    inbox = tmp_path / "IN"
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0", "3|c|3.0", "|n|0.5"])
    write(inbox, "UPDT", "20210102-000000", ["2|bb|20.0", "4|d|4.0", "|m|0.7"])
    write(inbox, "UPDT", "20210103-000000", ["4|dd|40.0", "1|aa|10.0", "5|e|bad"])
    results = []
    for bulk in (False, True):
        store = TableStore(spark, str(tmp_path / f"wh{bulk}"))
        table = f"BULK_{int(bulk)}"
        spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=table)
        rep = run_load(spark, spec, str(inbox), store, Journal(store, prefix=f"JB{int(bulk)}_"),
                       run_ts=RUN_TS, bulk=bulk)
        assert len(rep.files) == 3
        results.append(table_rows(store, table))
        if bulk:
            assert store.version(table) == 1          # one snapshot for the whole plan
    assert results[0] == results[1]
    assert len(results[0]) == 6            # ids 1-4 and the two NULL-key rows; 5 was rejected


def test_bucketed_target_rewrites_only_touched_buckets(spark, tmp_path):
    inbox = tmp_path / "IN"
    full = [f"{i}|n{i}|{i}.0" for i in range(1, 201)]
    write(inbox, "FULL", "20210101-000000", full)
    results = {}
    for buckets in (None, 16):
        store = TableStore(spark, str(tmp_path / f"wh{buckets}"))
        table = f"BKT_{buckets or 0}"
        spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                        custom_table_name=table, buckets=buckets)
        run_load(spark, spec, str(inbox), store, Journal(store, prefix=f"JK{buckets or 0}_"), run_ts=RUN_TS)
        if buckets:
            locations_before = {r[0]: r for r in spark.sql(f"SHOW PARTITIONS {store.target(table).parts_name}").collect()}
            assert len(locations_before) == 16
        results[buckets] = table_rows(store, table)
    assert [r[:3] for r in results[None]] == [r[:3] for r in results[16]]

    inbox = tmp_path / "IN2"                     # files are not moved: the next run gets a new folder
    write(inbox, "UPDT", "20210102-000000", ["7|seven|70.0", "300|new|3.0"])
    for buckets in (None, 16):
        store = TableStore(spark, str(tmp_path / f"wh{buckets}"))
        table = f"BKT_{buckets or 0}"
        spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                        custom_table_name=table, buckets=buckets)
        rep = run_load(spark, spec, str(inbox), store, Journal(store, prefix=f"JK{buckets or 0}_"), run_ts=RUN_TS)
        fr = rep.files[-1]
        assert (fr.before, fr.after_delete, fr.after) == (200, 199, 201)
        results[buckets] = table_rows(store, table)
    assert results[None] == [r for r in results[16]]
    # only the buckets of keys 7 and 300 are in the new segment
    store = TableStore(spark, str(tmp_path / "wh16"))
    files = spark.table("BKT_16").select(F.input_file_name().alias("f")).distinct().collect()
    segments = {f.f.split("/_segment=")[1].split("/")[0] for f in files}
    assert sorted(int(s.split("-")[0]) for s in segments) == [1, 2]
    new_buckets = {f.f.split("_bucket=")[1].split("/")[0] for f in files if "/_segment=000002-" in f.f}
    assert 1 <= len(new_buckets) <= 2


def test_reject_limit_counts_the_whole_run_and_key_warning(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|x"])               # 1 reject
    write(inbox, "UPDT", "20210102-000000", ["3|c|3.0", "4|d|y", "", "5|e|5"])  # 1 more reject
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="name",
                    threshold=3, custom_table_name=table)
    rep = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, check_primary_key=False)
    for fr in rep.files:                                 # every line is accounted for
        assert fr.n_good + fr.n_rejected + fr.n_discarded + fr.n_headings == fr.n_lines
    ev = events(journal, rep.run_id)
    assert [v for e, v in ev if e == "NBRows_rejected_table"] == ["1", "2"]
    assert ("WARNING", "UPDT : COLUMN_ID != TABLE_KEY") in ev
    write(inbox, "UPDT", "20210103-000000", ["6|f|z"])                          # third reject in a new run
    spec2 = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", threshold=2,
                     custom_table_name=table)
    with pytest.raises(RejectLimitExceeded):             # 1 + 1 reach the limit of 2 within the run
        run_load(spark, spec2, str(inbox), store, journal, run_ts=RUN_TS)


@pytest.mark.parametrize("buckets", [None, 4])
def test_incremental_primary_key_guard(spark, tmp_path, buckets):
    store = TableStore(spark, str(tmp_path / "wh"))
    journal = Journal(store, prefix=f"JP{buckets or 0}_")
    table = f"PKG_{buckets or 0}"
    first, second = tmp_path / "IN1", tmp_path / "IN2"
    write(first, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0"])
    # the delivery key is id, the table key is name: 'a' already belongs to id 1, which survives
    write(second, "UPDT", "20210102-000000", ["3|a|3.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="name",
                    custom_table_name=table, buckets=buckets)
    run_load(spark, spec, str(first), store, journal, run_ts=RUN_TS)
    with pytest.raises(PrimaryKeyViolation):
        run_load(spark, spec, str(second), store, journal, run_ts=RUN_TS)
    assert store.read(table).count() == 2
    # replacing the owner of 'a' in the same delivery is fine
    third = tmp_path / "IN3"
    write(third, "UPDT", "20210103-000000", ["1|z|1.0", "3|a|3.0"])
    run_load(spark, spec, str(third), store, journal, run_ts=RUN_TS)
    assert sorted(r.name for r in store.read(table).collect()) == ["a", "b", "z"]


def test_null_primary_key_refused_when_the_key_gate_covers_duplicates(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "|b|2.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                    custom_table_name=table)
    from loadwright.plans.load import GovernedLoad
    assert GovernedLoad(spark, spec, store, journal)._key_gate_covers_pk
    with pytest.raises(PrimaryKeyViolation):
        run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    # a projection may rewrite keys, so the full check is kept there
    projected = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                         select=["id % 2 AS id", "name", "amount"], custom_table_name=table)
    assert not GovernedLoad(spark, projected, store, journal)._key_gate_covers_pk


def test_stage_keeps_line_text_only_for_rejected_rows(spark, tmp_path):
    from loadwright.plans.load import parse_delivery
    from loadwright.sources import textscan as ts

    folder = tmp_path / "IN"
    write(folder, "FULL", "20210101-000000", ["1|a|1.0", "2|b|x", "", "3|c|3.0|9"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|")
    got = {(r[ts.STATUS], r[ts.LINE]) for r in parse_delivery(spark, spec, str(folder)).collect()}
    assert got == {("good", None), ("rejected", "2|b|x"), ("discarded", None), ("rejected", "3|c|3.0|9")}


@pytest.mark.parametrize("bulk", [False, True])
def test_skip_applied_files_like_a_history_folder(spark, env, bulk):
    store, journal, table, inbox = env
    write(inbox, "UPDT", "20210101-000000", ["1|a|1.0", "2|b|2.0"])          # no key: INST
    write(inbox, "UPDT", "20210102-000000", ["3|c|3.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", custom_table_name=table)
    first = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, bulk=bulk)
    assert len(first.files) == 2 and store.read(table).count() == 3
    again = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, bulk=bulk)
    assert again.files == [] and store.read(table).count() == 3              # nothing appended twice
    write(inbox, "UPDT", "20210103-000000", ["4|d|4.0"])
    third = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, bulk=bulk)
    assert [f.file_name for f in third.files] == [name("UPDT", "20210103-000000")]
    assert store.read(table).count() == 4


def test_a_failed_delivery_is_not_counted_as_applied(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0"])
    write(inbox, "UPDT", "20210102-000000", ["3|c|3.0", "3|d|4.0"])          # duplicate key: refused
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=table)
    with pytest.raises(DuplicateKeys):
        run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    applied = {r.file_name for r in journal.applied_files(spec.object_name).collect()}
    assert applied == {name("FULL", "20210101-000000")}


def test_journal_compaction_keeps_rows_and_ids(spark, tmp_path):
    import glob

    store = TableStore(spark, str(tmp_path / "wh"))
    journal = Journal(store, prefix="JC_")
    journal.ensure()
    for i in range(4):
        run_id = journal.open_run("P", "src.base.acct", f"2021-01-0{i + 1} 00:00:00")
        journal.event(run_id, "Dataloader", "Begin", f"2021-01-0{i + 1} 00:00:00")
        journal.flush()
        journal.close_run(run_id, f"2021-01-0{i + 1} 00:00:01")
    before = sorted(tuple(r) for r in store.read(journal.runs).collect())
    old_files = glob.glob(str(tmp_path / "wh" / journal.runs / "*.parquet"))
    journal.compact()
    folder = store.location(journal.runs).replace("file:", "")
    assert folder.endswith(".c000001")
    assert sorted(tuple(r) for r in store.read(journal.runs).collect()) == before
    assert len(glob.glob(folder + "/*.parquet")) < len(old_files)
    assert journal.open_run("P", "src.base.acct", "2021-01-05 00:00:00") == 5      # ids continue
    journal.compact()
    assert store.location(journal.runs).endswith(".c000002")
    assert store.read(journal.runs).count() == len(before) + 1


@pytest.mark.parametrize("scan", [False, True])
def test_statistics_are_size_only_unless_a_scan_is_asked_for(spark, env, scan):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0", "3|c|3.0"])
    spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=table,
                    analyze_scan=scan)
    run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    target = store.target(table)
    described = lambda more: [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target.parts_name} {more}").collect()
                              if r.col_name in ("Statistics", "Partition Statistics")]
    assert "bytes" in described("")[0]
    segment = target.snapshot().segments[0].name
    assert any("3 rows" in d for d in described(f"PARTITION (_segment = '{segment}')")) == scan


def test_key_gate_shortcut_needs_the_same_key_type_in_stage_and_target(spark, env):
    from loadwright.plans.load import GovernedLoad

    store, journal, table, _ = env
    same = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                    custom_table_name=table)
    cast = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id",
                    stage_columns="id STRING, name STRING, amount DOUBLE", custom_table_name=table)
    other_key = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="name",
                         custom_table_name=table)
    assert GovernedLoad(spark, same, store, journal)._key_gate_covers_pk
    assert not GovernedLoad(spark, cast, store, journal)._key_gate_covers_pk      # '1' and '01' -> 1
    assert not GovernedLoad(spark, other_key, store, journal)._key_gate_covers_pk


def test_load_with_date_masks(spark, env):
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|20200310", "2|2020-03-10", "3|"])
    spec = LoadSpec("src.base.acct", "id BIGINT, d DATE", delimiter="|", custom_table_name=table, formats={"d": "yyyyMMdd"})
    report = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS)
    assert sorted((r.id, str(r.d)) for r in store.read(table).collect()) == [(1, "2020-03-10"), (3, "None")]
    assert report.files[0].n_rejected == 1
