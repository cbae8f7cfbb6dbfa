import pytest

from loadwright.operators import rejects as R
from loadwright.sources import deliveries as D


def names_df(spark, items):
    paths = [(f"/x/v1.2/IN/SRC.BASE.OBJ.J.00.MFT.{m}.ALL.{i:03d}.{d}.{d}",) for i, (m, d) in enumerate(items)]
    return D.parse_delivery_names(spark.createDataFrame(paths, "path string"))


def planned(spark, items, keys="id"):
    plan = D.plan_deliveries(names_df(spark, items), keys=keys)
    return [(p["load_mode"], p["file_date"], p["effective_mode"]) for p in D.plan_list(plan)]


def test_name_fields_from_base_name(spark):
    r = names_df(spark, [("FULL", "20200310-000000")]).first()
    assert r.load_mode == "FULL" and r.file_date == "20200310-000000"
    assert r.file_name.startswith("SRC.BASE.OBJ")


def test_plan_newest_full_then_later_updates(spark):
    items = [("FULL", "20200101-000000"), ("FULL", "20200301-000000"), ("UPDT", "20200201-000000"),
             ("UPDT", "20200301-000000"), ("UPDT", "20200401-000000"), ("PURG", "20200501-000000")]
    assert planned(spark, items) == [("FULL", "20200301-000000", "FULL"), ("UPDT", "20200401-000000", "UPDT")]
    names = names_df(spark, items)
    plan = D.plan_deliveries(names, keys="id")
    left = sorted(r.load_mode + r.file_date for r in D.unprocessed_deliveries(names, plan).collect())
    assert left == sorted(["FULL20200101-000000", "UPDT20200201-000000", "UPDT20200301-000000",
                           "PURG20200501-000000"])


def test_plan_without_full_and_without_keys(spark):
    items = [("UPDT", "20200201-000000"), ("UPDT", "20200101-000000"), ("XXXX", "20200101-000000")]
    assert planned(spark, items, keys=None) == [("UPDT", "20200101-000000", "INST"),
                                                ("UPDT", "20200201-000000", "INST")]


def test_plan_per_object(spark):
    paths = [("/in/S.B.A.J.00.MFT.FULL.ALL.0.20200102-000000.x",), ("/in/S.B.A.J.00.MFT.UPDT.ALL.0.20200101-000000.x",),
             ("/in/S.B.C.J.00.MFT.UPDT.ALL.0.20200101-000000.x",)]
    names = D.parse_delivery_names(spark.createDataFrame(paths, "path string"))
    from pyspark.sql import functions as F
    names = names.withColumn("object", F.get(F.split("file_name", "\\."), 2))
    plan = D.plan_deliveries(names, keys="k", by=["object"])
    assert sorted((r.object, r.load_mode) for r in plan.collect()) == [("A", "FULL"), ("C", "UPDT")]


def test_empty_folder_lists_nothing(spark, tmp_path):
    empty = tmp_path / "IN"
    empty.mkdir()
    assert D.list_deliveries(spark, str(empty)).count() == 0


def test_folder_deliveries_are_listed_once(spark, tmp_path):
    name = "SRC.BASE.OBJ.J.00.MFT.FULL.ALL.000.20200101-000000.20200101-000000"
    spark.range(100).selectExpr("cast(id as string) as value").repartition(3).write.text(str(tmp_path / "IN" / name))
    got = D.parse_delivery_names(D.list_deliveries(spark, str(tmp_path / "IN"))).collect()
    assert len(got) == 1 and got[0].file_name == name and got[0].n_files == 3


@pytest.mark.parametrize("n,limit,passed", [(9, 10, True), (10, 10, False), (11, 10, False), (0, 1, True)])
def test_reject_gate_boundary(n, limit, passed):
    assert R.reject_gate(n, limit, raise_on_fail=False).passed is passed
    if not passed:
        with pytest.raises(R.RejectLimitExceeded):
            R.reject_gate(n, limit)


def test_gate_table(spark):
    counts = spark.createDataFrame([(5,)], "n_rejected bigint")
    got = {r.threshold: r.passed for r in R.gate_table(counts, [4, 5, 6]).collect()}
    assert got == {4: False, 5: False, 6: True}


def test_file_date_ignores_session_time_zone(spark):
    from pyspark.sql import functions as F

    from loadwright.functions.names import file_date_ts
    from loadwright.operators.transform import stamp_audit

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("20200308-023000",), ("2020x",), ("20201399-000000",)], "s string")
        got = [str(r[0]) for r in df.select(file_date_ts("s")).collect()]
        stamped = stamp_audit(spark.range(1), "20200308-023000", "2020-03-08 02:30:01.5").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2020-03-08 02:30:00", "None", "None"]
    assert str(stamped.METADATA_TM_FILE) == "2020-03-08 02:30:00"
    assert str(stamped.METADATA_TM_INSERT) == "2020-03-08 02:30:01"
