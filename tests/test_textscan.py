import pytest
from pyspark.sql import functions as F

from loadwright.functions.render import delimited_line, fixed_width_line
from loadwright.sources import textscan as ts

ORDERS4 = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def _by_line(parsed):
    return {r[ts.LINE]: r for r in parsed.collect()}


def test_delimited_cases(spark):
    rows = ["1|899|P|112946.26", "2||P|10.0", "3|899|P", "4|899|P|x", "5|899|P|1.0|extra",
            '6|899|"P|1.0', ""]
    got = _by_line(ts.parse_delimited(_lines(spark, rows), ORDERS4, "|"))
    assert got["1|899|P|112946.26"][ts.STATUS] == ts.GOOD
    assert got["1|899|P|112946.26"]["o_totalprice"] == 112946.26
    assert got["2||P|10.0"][ts.STATUS] == ts.GOOD and got["2||P|10.0"]["o_custkey"] is None
    assert got["3|899|P"][ts.STATUS] == ts.GOOD and got["3|899|P"]["o_totalprice"] is None
    assert got["4|899|P|x"][ts.STATUS] == ts.REJECTED
    assert "o_totalprice" in got["4|899|P|x"][ts.REASON]
    assert got["5|899|P|1.0|extra"][ts.STATUS] == ts.REJECTED
    assert "more than 4 fields" in got["5|899|P|1.0|extra"][ts.REASON]
    assert got['6|899|"P|1.0'][ts.STATUS] == ts.GOOD and got['6|899|"P|1.0']["o_orderstatus"] == '"P'
    assert got[""][ts.STATUS] == ts.DISCARDED and got[""][ts.REASON] is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_date_masks(spark, zone):
    schema = "k INT, d DATE, t TIMESTAMP_NTZ"
    masks = {"d": "yyyyMMdd", "t": "yyyyMMddHHmmss"}
    rows = ["1|20200310|20200308023000", "2|2020-03-10|", "3|20201345|19011231235959", "4||20200310"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r[ts.LINE][0]: r for r in ts.parse_delimited(_lines(spark, rows), schema, "|", formats=masks).selectExpr(
            ts.LINE, ts.STATUS, "CAST(d AS STRING) d", "CAST(t AS STRING) t").collect()}
        wide = ts.parse_fixed_width(_lines(spark, ["520200310"]), "k INT, d DATE", [1, 8], formats={"d": "yyyyMMdd"})
        assert wide.selectExpr("CAST(d AS STRING) d").first().d == "2020-03-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {k: r[ts.STATUS] for k, r in got.items()} == {"1": ts.GOOD, "2": ts.REJECTED, "3": ts.REJECTED, "4": ts.REJECTED}
    assert (got["1"].d, got["1"].t) == ("2020-03-10", "2020-03-08 02:30:00")  # no such hour in New York
    assert got["3"].t == "1901-12-31 23:59:59"


@pytest.mark.parametrize("masks", [{"x": "yyyy"}, {"k": "yyyy"}])
def test_date_masks_need_a_date_column(spark, masks):
    with pytest.raises(ValueError):
        ts.parse_delimited(_lines(spark, ["1"]), "k INT", "|", formats=masks)


def test_short_rows_rejected_when_not_padded(spark):
    got = _by_line(ts.parse_delimited(_lines(spark, ["3|899|P", "1|2|P|3.0"]), ORDERS4, "|",
                                      pad_short_rows=False))
    assert got["3|899|P"][ts.STATUS] == ts.REJECTED
    assert got["1|2|P|3.0"][ts.STATUS] == ts.GOOD


def test_delimiter_is_literal(spark):
    got = ts.parse_delimited(_lines(spark, ["1.|2.|x"]), "a INT, b INT, c STRING", ".|").collect()
    assert (got[0]["a"], got[0]["b"], got[0]["c"], got[0][ts.STATUS]) == (1, 2, "x", ts.GOOD)
    bs = ts.parse_delimited(_lines(spark, ["a\\b;c"]), "x STRING, y STRING", ";").collect()[0]
    assert bs["x"] == "a\\b" and bs["y"] == "c"


PART = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
WIDTHS = [8, 24, 10, 20, 4, 10]


def test_fixed_width_characters_blanks_and_long_rows(spark):
    def row(*vals):
        return "".join(str(v).ljust(w) for v, w in zip(vals, WIDTHS))
    rows = [row(1, "crème brûlée", "Brand#1", "ECONOMY", 7, 900.5),
            row(2, "", "Brand#2", "SMALL", 3, 10.0),
            row(3, "x", "Brand#3", "SMALL", "ab", 1.0),
            row(4, "y", "B", "T", 1, 2.0) + "junk",
            row(5, "z", "B", "T", 1, 2.0) + "   ",
            "6       short"]
    got = {r["p_partkey"]: r for r in ts.parse_fixed_width(_lines(spark, rows), PART, WIDTHS).collect()
           if r["p_partkey"] is not None}
    assert got[1]["p_name"] == "crème brûlée" and got[1]["p_retailprice"] == 900.5
    assert got[1][ts.STATUS] == ts.GOOD
    assert got[2]["p_name"] is None and got[2][ts.STATUS] == ts.GOOD
    assert got[3][ts.STATUS] == ts.REJECTED and "p_size" in got[3][ts.REASON]
    assert got[4][ts.STATUS] == ts.REJECTED
    assert got[5][ts.STATUS] == ts.GOOD
    assert got[6]["p_name"] == "short" and got[6]["p_size"] is None and got[6][ts.STATUS] == ts.GOOD


def test_round_trip_delimited_and_fixed(spark):
    df = spark.createDataFrame(
        [(1, "a b", 2.5, None), (2, None, -1.25, "x"), (3, "ü", 1e-3, "yy")],
        "k BIGINT, s STRING, d DOUBLE, t STRING")
    lines = df.select(delimited_line(df.columns, ";").alias("value"))
    back = ts.good_rows(ts.parse_delimited(lines, "k BIGINT, s STRING, d DOUBLE, t STRING", ";"),
                        "k BIGINT, s STRING, d DOUBLE, t STRING")
    assert sorted(back.collect()) == sorted(df.collect())
    fixed = df.select(fixed_width_line(df.columns, [4, 5, 8, 3]).alias("value"))
    back2 = ts.good_rows(ts.parse_fixed_width(fixed, "k BIGINT, s STRING, d DOUBLE, t STRING", [4, 5, 8, 3]),
                         "k BIGINT, s STRING, d DOUBLE, t STRING")
    assert sorted(back2.collect()) == sorted(df.collect())


def test_skip_lines_per_file_across_splits(spark, write_text, tmp_path):
    a = write_text("a.txt", ["HEAD A1", "HEAD A2"] + [f"{i}|a" for i in range(2000)], "in")
    write_text("b.txt", ["HEAD B1", "HEAD B2"] + [f"{i}|b" for i in range(500)], "in")
    write_text("c.txt", ["HEAD C1"], "in")          # shorter than the heading
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # many splits per file
    try:
        lines = ts.read_lines(spark, str(tmp_path / "in"), with_position=True)
        assert lines.rdd.getNumPartitions() > 3
        body = ts.skip_lines(lines, 2)
        values = [r["value"] for r in body.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert not [v for v in values if v.startswith("HEAD")]
    assert len(values) == 2500
    assert a


def test_line_counts_add_up(spark):
    rows = ["1|2|P|1.0", "x|2|P|1.0", "", "  ", "1|2|P|1.0|9"]
    c = ts.line_counts(ts.parse_delimited(_lines(spark, rows), ORDERS4, "|")).first()
    assert (c.n_lines, c.n_good, c.n_rejected, c.n_discarded) == (5, 1, 2, 2)
    assert c.n_good + c.n_rejected + c.n_discarded == c.n_lines


def test_good_filter_plan_parses_each_line_once(spark):
    lines = _lines(spark, ["1|2|P|1.0"])
    plan = ts.good_rows(ts.parse_delimited(lines, ORDERS4, "|"), ORDERS4)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert plan.count("split(") == 1


@pytest.mark.parametrize("bad", ["", "8,x"])
def test_widths_validation(bad):
    from loadwright.functions.tokens import parse_widths, fixed_width_starts
    with pytest.raises(ValueError):
        fixed_width_starts(parse_widths(bad))


def test_custom_line_separator(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("1|a;2|b;3|c")
    lines = ts.read_lines(spark, str(p), line_sep=";")
    got = ts.good_rows(ts.parse_delimited(lines, "k INT, v STRING", "|"), "k INT, v STRING").collect()
    assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "b"), (3, "c")]
