"""Loads that are safe to repeat, gated before the switch, and models on real labels."""

import pytest
from pyspark.sql import functions as F

from loadwright.models import classify, ols
from loadwright.operators.counts import ReconciliationError
from loadwright.plans import LoadSpec, run_load
from loadwright.sources import textscan as ts
from tests.test_load import COLS, RUN_TS, env, events, name, table_rows, write  # noqa: F401


def spec_of(table, **kw):
    return LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", table_key="id", custom_table_name=table, **kw)


def old_and_new(inbox):
    write(inbox, "FULL", "20210101-000000", ["1|old|1.0"])
    write(inbox, "UPDT", "20210115-000000", ["2|stale|2.0"])
    write(inbox, "FULL", "20210201-000000", ["1|new|1.0", "3|new|3.0"])


@pytest.mark.parametrize("bulk", [False, True])
def test_later_runs_do_not_roll_back(spark, env, bulk):  # noqa: F811
    store, journal, table, inbox = env
    old_and_new(inbox)
    write(inbox, "UPDT", "20210301-000000", ["3|upd|4.0"])
    want = [(1, "new", 1.0, "2021-02-01 00:00:00"), (3, "upd", 4.0, "2021-03-01 00:00:00")]
    for _ in range(3):
        run_load(spark, spec_of(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True, bulk=bulk)
        assert table_rows(store, table) == want


def test_run_that_fails_half_way_retires_the_files_it_passed_over(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    old_and_new(inbox)
    write(inbox, "UPDT", "20210301-000000", ["4|x|1.0", "4|y|1.0"])  # duplicate keys
    for _ in range(2):
        with pytest.raises(Exception):
            run_load(spark, spec_of(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
        assert [r[:2] for r in table_rows(store, table)] == [(1, "new"), (3, "new")]
    (inbox / name("UPDT", "20210301-000000")).write_text("3|upd|4.0\n")
    run_load(spark, spec_of(table), str(inbox), store, journal, run_ts=RUN_TS, skip_applied=True)
    assert [r[:2] for r in table_rows(store, table)] == [(1, "new"), (3, "upd")]


@pytest.mark.parametrize("mode,bulk", [("FULL", False), ("UPDT", False), ("UPDT", True)])
def test_failed_reconciliation_keeps_the_old_rows(spark, env, mode, bulk):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0"])
    run_load(spark, spec_of(table), str(inbox), store, journal, run_ts=RUN_TS)
    before = table_rows(store, table)
    more = inbox.parent / "IN2"
    write(more, mode, "20210201-000000", ["2|bb|2.0", "3|c|3.0"])
    if bulk:
        write(more, "UPDT", "20210202-000000", ["4|d|4.0"])
    doubled = ["explode(array(id, id)) AS id", "name", "amount"]
    bad = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=table, select=doubled)
    with pytest.raises(ReconciliationError):
        run_load(spark, bad, str(more), store, journal, run_ts=RUN_TS, bulk=bulk)
    assert table_rows(store, table) == before


@pytest.mark.parametrize("buckets", [None, 4])
def test_bulk_counts_are_those_of_single_loads(spark, env, buckets):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0", "2|b|2.0", "3|c|3.0"])
    write(inbox, "UPDT", "20210102-000000", ["2|bb|2.0", "4|d|4.0", "|n|0.0"])
    write(inbox, "UPDT", "20210103-000000", ["4|dd|4.0", "3|cc|3.0"])
    seen = []
    for bulk, t in ((False, table + "_S"), (True, table + "_B")):
        spec = LoadSpec("src.base.acct", COLS, delimiter="|", column_id="id", custom_table_name=t, buckets=buckets)
        rep = run_load(spark, spec, str(inbox), store, journal, run_ts=RUN_TS, bulk=bulk)
        counts = ("NBRows_before_loading", "NBRows_table_after_delete_request", "NBRows_after_loading")
        seen.append(([(f.before, f.after_delete, f.after) for f in rep.files], table_rows(store, t),
                     [e for e in events(journal, rep.run_id) if e[0] in counts]))
    assert seen[0] == seen[1] and [c[2] for c in seen[0][0]] == [3, 5, 5]


def test_stage_is_dropped_and_old_versions_vacuumed(spark, env):  # noqa: F811
    store, journal, table, inbox = env
    write(inbox, "FULL", "20210101-000000", ["1|a|1.0"])
    for _ in range(4):
        run_load(spark, spec_of(table), str(inbox), store, journal, run_ts=RUN_TS)
    folder = spec_of(table).table_name
    assert not list((inbox.parent / "wh" / "_stage" / folder).iterdir())
    assert store.vacuum(folder, keep=2) == [1, 2] and len(table_rows(store, table)) == 1


def test_over_long_values_are_rejected(spark):
    lines = spark.createDataFrame([("1|abc",), ("2|abcd",), ("3|",)], "value string")
    got = {r.id: r for r in ts.parse_delimited(lines, "id INT, v VARCHAR(3)", "|").collect()}
    assert got[1][ts.STATUS] == got[3][ts.STATUS] == ts.GOOD and got[1]["v"] == "abc"
    assert got[2][ts.STATUS] == ts.REJECTED and "longer than varchar(3)" in got[2][ts.REASON]


@pytest.mark.parametrize("split_bytes", ["9", "1m"])
def test_headings_over_splits(spark, tmp_path, split_bytes):
    """Headings longer than a split, several files, a short one and an empty one; the text is scanned once."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a").write_text("H1\nH2\nH3 is longer\n" + "".join(f"{i}|a\n" for i in range(40)))
    (folder / "b").write_text("H1\nH2\nH3\n1|b\n")
    (folder / "c").write_text("H1\nH2\n")
    (folder / "d").write_text("")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, split_bytes)
        body = ts.skip_lines(ts.read_lines(spark, str(folder), with_position=True), 3)
        assert sorted(r["value"] for r in body.collect()) == sorted([f"{i}|a" for i in range(40)] + ["1|b"])
        assert "FileScan text" not in body._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    with pytest.raises(ValueError):
        ts.skip_lines(ts.read_lines(spark, str(folder)), 3)


def test_classes_of_any_type(spark):
    rows = [(float(i % 3), float(i), ["low", "mid", "top"][i % 3], [2, 5, 9][i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "a double, b double, s string, n int")
    for label in ("s", "n"):
        for model in (classify.logit_fit(df, label, ["a"]), classify.forest_fit(df, label, ["a"])):
            assert model.numClasses == 3
            assert classify.logit_predict(model, df, ["a"]).where(F.col(label) != F.col("prediction")).count() == 0
    nodes = classify.tree_nodes(spark, classify.forest_fit(df, "s", ["a"]), features=["a"])
    assert {r["class"] for r in nodes.collect()} <= {"low", "mid", "top"}


def test_singular_designs_are_named(spark):
    df = spark.range(20).selectExpr("CAST(id AS DOUBLE) AS y", "CAST(id AS DOUBLE) AS x", "2.0D * id AS x2", "1.0D AS c")
    with pytest.raises(ols.SingularDesign):
        ols.ols_fit(df, "y", ["x", "x2"])
    with pytest.raises(ols.SingularDesign):
        ols.regression_line(df, "y", "c")
    assert ols.regression_points(df, "y", "x").count() == 20
