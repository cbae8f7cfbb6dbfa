"""Registered queries: each operator exercised on the driver's tables.

Every query reads the given Parquet tables (or text that Spark renders from
them) in full, so its work grows with the data.  Text deliveries are built
from table rows with ``concat_ws`` / ``rpad``; the oracle SQL therefore states
the expected answer directly on the original columns.

Scenario rules (which rows a delivery holds, which lines are damaged) are
stated once here as constants and used by both the Spark side and the SQL.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.render import delimited_line, fixed_width_line
from loadwright.models import ols as ols_mod
from loadwright.operators import counts as counts_mod
from loadwright.operators import keys as keys_mod
from loadwright.operators import modes as modes_mod
from loadwright.operators import rejects as rejects_mod
from loadwright.operators import transform as tf
from loadwright.session import scratch_path
from loadwright.sources import csv as csv_mod
from loadwright.sources import deliveries as dl
from loadwright.sources import textscan as ts

# ---------------------------------------------------------------------------
# Scenario constants (shared by Spark and SQL)
# ---------------------------------------------------------------------------
RUN_TS = "2020-03-10 16:01:00"
OLD_RUN_TS = "2020-01-01 06:00:00"
OLD_FILE_DATE = "20200101-000000"
NEW_FILE_DATE = "20200310-000000"
TARGET_BEFORE = "2000-01-01 00:00:00"     # the old snapshot holds rows before this
DELIVERY_FROM = "1999-01-01 00:00:00"     # a delivery holds rows from this on

ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_DDL = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
PART_DDL = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE")
PART_WIDTHS = [8, 24, 10, 20, 4, 10]
TEXT_HEADINGS = ["ORDERS EXPORT", "|".join(ORDERS_COLS)]

# Damaged delivery lines (orders):
#   price token replaced by 'n/a'          when status P and priority 5-LOW
#   an extra trailing field '|extra'        when status F and priority 1-URGENT
#   a blank line after the order's line     when status O and priority 3-MEDIUM
BROKEN_SQL = "(o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"
EXTRA_SQL = "(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"
BLANK_SQL = "(o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM')"
BAD_PRICE = "n/a"
FORMATS_DDL = "o_orderkey BIGINT, order_day DATE, order_time TIMESTAMP_NTZ"
FORMATS = {"order_day": "yyyyMMdd", "order_time": "dd.MM.yyyy HH:mm:ss"}
PK_NULL_SQL = "(l_quantity = 50)"          # l_orderkey arrives empty on these lines


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _sql_ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _file_ts_sql(file_date: str) -> str:
    d = file_date
    return _sql_ts(f"{d[0:4]}-{d[4:6]}-{d[6:8]} {d[9:11]}:{d[11:13]}:{d[13:15]}")


_OPENED: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, opened once per session.

    Opening Parquet infers its schema with a small Spark job; the input tables
    are fixed, so each session keeps the reader (a lazy plan, no data) and
    every query builds on it, as it would on a catalog table.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    opened = _OPENED.setdefault(spark, {})
    if path not in opened:
        opened[path] = spark.read.parquet(path)
    return opened[path]


# ---------------------------------------------------------------------------
# Delivery text built from tables
# ---------------------------------------------------------------------------

def orders_delivery(orders: DataFrame, price_delta: float = 0.0, broken: bool = True,
                    extra: bool = False, blanks: bool = False) -> DataFrame:
    """Orders as '|' lines (column ``value``), with the damaged lines of the rules above."""
    price = F.col("o_totalprice") + F.lit(price_delta) if price_delta else F.col("o_totalprice")
    if broken:
        price = F.when(F.expr(BROKEN_SQL), F.lit(BAD_PRICE)).otherwise(price.cast("string"))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", price, "o_orderdate", "o_orderpriority"]
    line = delimited_line(cols, "|")
    if extra:
        line = F.when(F.expr(EXTRA_SQL), F.concat(line, F.lit("|extra"))).otherwise(line)
    if blanks:
        return orders.select(F.explode(F.when(F.expr(BLANK_SQL), F.array(line, F.lit("")))
                                       .otherwise(F.array(line))).alias("value"))
    return orders.select(line.alias("value"))


def lineitem_delivery(lineitem: DataFrame, quantity_delta: float = 0.0) -> DataFrame:
    q = F.col("l_quantity") + F.lit(quantity_delta) if quantity_delta else F.col("l_quantity")
    cols = [q if c == "l_quantity" else c for c in LINEITEM_COLS]
    return lineitem.select(delimited_line(cols, "|").alias("value"))


def _parsed_orders(lines: DataFrame) -> DataFrame:
    return ts.parse_delimited(lines, ORDERS_DDL, "|")


def _old_orders_target(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _ts(TARGET_BEFORE))
    return tf.stamp_audit(o.select(*ORDERS_COLS), OLD_FILE_DATE, OLD_RUN_TS)


def _orders_update_stage(spark, sf_dir) -> DataFrame:
    """Flagship delivery: orders from DELIVERY_FROM, price + 1, all three damage kinds."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= _ts(DELIVERY_FROM))
    return _parsed_orders(orders_delivery(o, price_delta=1.0, broken=True, extra=True, blanks=True))


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

def q_parse_delimited(spark, sf_dir):
    lines = orders_delivery(table(spark, sf_dir, "orders"), broken=False)
    return ts.good_rows(_parsed_orders(lines), ORDERS_DDL)


def q_parse_formats(spark, sf_dir):
    """Order dates written by their masks; those of the broken lines carry dashes and are rejected."""
    day = F.when(F.expr(BROKEN_SQL), F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    time = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss")
    lines = table(spark, sf_dir, "orders").select(delimited_line(["o_orderkey", day, time], "|").alias("value"))
    parsed = ts.parse_delimited(lines, FORMATS_DDL, "|", formats=FORMATS)
    return parsed.select("o_orderkey", F.col("order_day").cast("timestamp_ntz").alias("order_day"), "order_time", F.col(ts.STATUS).alias("status"), F.col(ts.REASON).alias("reason"))


def q_parse_fixed_width(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    cols = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    lines = part.select(fixed_width_line(cols, PART_WIDTHS).alias("value"))
    return ts.good_rows(ts.parse_fixed_width(lines, PART_DDL, PART_WIDTHS), PART_DDL)


def write_orders_text(spark, sf_dir, files: int = 16) -> str:
    """Orders as '|' text in ``files`` folders by a hash of the key, each file led by two heading lines."""
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).cast("int").alias("part")
    heads = spark.range(files).select(F.col("id").cast("int").alias("part"),
                                      F.posexplode(F.array(*[F.lit(h) for h in TEXT_HEADINGS])).alias("_ord", "value"))
    line = delimited_line(ORDERS_COLS, "|")
    body = table(spark, sf_dir, "orders").select(part, F.lit(len(TEXT_HEADINGS)).alias("_ord"), line.alias("value"))
    path = scratch_path(spark, "orders-text")
    (heads.unionByName(body).repartition(files, "part").sortWithinPartitions("part", "_ord")
     .select("part", "value").write.partitionBy("part").text(path))
    return path


def q_skip_lines(spark, sf_dir):
    path = write_orders_text(spark, sf_dir)
    parsed = ts.parse_delimited(ts.read_lines(spark, path, with_position=True), ORDERS_DDL, "|")
    stage = scratch_path(spark, "orders-stage")
    parsed.drop(ts.LINE, ts.REASON).write.parquet(stage)        # the one scan of the text
    flagged = ts.flag_headings(spark.read.parquet(stage), len(TEXT_HEADINGS))
    return ts.good_rows(flagged.where(~F.col(ts.HEADING)), ORDERS_DDL)


def _supplier_csv(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "supplier-csv")
    table(spark, sf_dir, "supplier").write.option("header", True).csv(path)
    return csv_mod.read_csv(spark, path)


def q_read_csv_inferred(spark, sf_dir):
    return _supplier_csv(spark, sf_dir)


def q_first_rows(spark, sf_dir):
    return tf.first_rows(_supplier_csv(spark, sf_dir), 10, [F.col("s_acctbal").desc(), "s_suppkey"])


def q_rejected_lines(spark, sf_dir):
    lines = orders_delivery(table(spark, sf_dir, "orders"), broken=True, extra=True)
    return rejects_mod.rejected_rows(_parsed_orders(lines), 1, RUN_TS, with_reason=True)


def q_discard_and_gate(spark, sf_dir):
    lines = orders_delivery(table(spark, sf_dir, "orders"), broken=True, extra=True, blanks=True)
    counts = ts.line_counts(_parsed_orders(lines))
    deltas = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("delta")
    return (counts.select("*", deltas)
            .withColumn("threshold", F.col("n_rejected") + F.col("delta"))
            .withColumn("passed", F.col("n_rejected") < F.col("threshold")))


def delivery_listing(spark, sf_dir) -> DataFrame:
    """A listing of delivery files named after the events (one file per event)."""
    ev = table(spark, sf_dir, "events")
    hour = F.hour("ts")
    mode = (F.when(hour == 0, F.lit("FULL")).when(hour == 23, F.lit("PURG")).otherwise(F.lit("UPDT")))
    stamp = F.date_format("ts", "yyyyMMdd-HHmmss")
    name = F.concat_ws(".", F.lit("SRC"), F.lit("BASE"), F.upper("event_type"), F.lit("J"), F.lit("00"),
                       F.lit("MFT"), mode, F.lit("ALL"), F.col("event_id").cast("string"), stamp, stamp)
    return ev.select(F.concat(F.lit("/data/v1.2/IN/"), name).alias("path"))


def _delivery_names(spark, sf_dir) -> DataFrame:
    names = dl.parse_delivery_names(delivery_listing(spark, sf_dir))
    return names.withColumn("object", F.get(F.split("file_name", "\\."), 2))


def q_delivery_names(spark, sf_dir):
    return dl.parse_delivery_names(delivery_listing(spark, sf_dir))


def q_delivery_plan(spark, sf_dir):
    plan = dl.plan_deliveries(_delivery_names(spark, sf_dir), keys="id", by=["object"])
    return plan.select("object", "file_name", "load_mode", "file_date", "effective_mode")


def q_delivery_unprocessed(spark, sf_dir):
    names = _delivery_names(spark, sf_dir)
    plan = dl.plan_deliveries(names, keys="id", by=["object"])
    return dl.unprocessed_deliveries(names, plan).select("path", "file_name", "load_mode", "file_date")


def q_load_full(spark, sf_dir):
    target = _old_orders_target(spark, sf_dir)
    lines = orders_delivery(table(spark, sf_dir, "orders"), broken=True)
    stage = tf.stamp_audit(ts.good_rows(_parsed_orders(lines), ORDERS_DDL), NEW_FILE_DATE, RUN_TS)
    return modes_mod.load_full(target, stage)


def q_load_update_single(spark, sf_dir):
    target = _old_orders_target(spark, sf_dir)
    stage = tf.stamp_audit(ts.good_rows(_orders_update_stage(spark, sf_dir), ORDERS_DDL),
                           NEW_FILE_DATE, RUN_TS)
    return modes_mod.load_update(target, stage, ["o_orderkey"])


def _lineitem_target(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < _ts(TARGET_BEFORE))
    return tf.stamp_audit(li.select(*LINEITEM_COLS), OLD_FILE_DATE, OLD_RUN_TS)


def _lineitem_stage(spark, sf_dir) -> DataFrame:
    """Lineitem from DELIVERY_FROM with quantity + 1: every row of the window, repeated keys too."""
    window = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= _ts(DELIVERY_FROM))
    parsed = ts.parse_delimited(lineitem_delivery(window, quantity_delta=1.0), LINEITEM_DDL, "|")
    return tf.stamp_audit(ts.good_rows(parsed, LINEITEM_DDL), NEW_FILE_DATE, RUN_TS)


def q_load_update_composite(spark, sf_dir):
    return modes_mod.load_update(_lineitem_target(spark, sf_dir), _lineitem_stage(spark, sf_dir), LINEITEM_KEYS)


def q_load_update_removed(spark, sf_dir):
    return keys_mod.matched_by_key(_lineitem_target(spark, sf_dir), _lineitem_stage(spark, sf_dir), LINEITEM_KEYS)


def q_load_insert(spark, sf_dir):
    target = _old_orders_target(spark, sf_dir)
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= _ts(DELIVERY_FROM))
    stage = tf.stamp_audit(ts.good_rows(_parsed_orders(orders_delivery(o)), ORDERS_DDL), NEW_FILE_DATE, RUN_TS)
    return modes_mod.apply_mode(target, stage, "UPDT", keys=None)   # no keys: runs as INST


# Deliveries of the sequence scenario: (file date, mode, first date, end date, price delta)
SEQUENCE = [
    ("20191101-000000", "FULL", None, "1997-01-01 00:00:00", 0.0),
    ("20191201-000000", "UPDT", "2000-06-01 00:00:00", None, 5.0),
    ("20200101-000000", "FULL", None, "1998-01-01 00:00:00", 0.0),
    ("20200201-000000", "UPDT", "1997-01-01 00:00:00", "2000-01-01 00:00:00", 1.0),
    ("20200301-000000", "UPDT", "1999-06-01 00:00:00", None, 2.0),
]


def _sequence_name(file_date: str, mode: str) -> str:
    return f"SRC.BASE.ORDERS.J.00.MFT.{mode}.ALL.000.{file_date}.{file_date}"


def q_load_sequence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stages = {}
    for file_date, mode, lo, hi, delta in SEQUENCE:
        o = orders
        if lo:
            o = o.where(F.col("o_orderdate") >= _ts(lo))
        if hi:
            o = o.where(F.col("o_orderdate") < _ts(hi))
        good = ts.good_rows(_parsed_orders(orders_delivery(o, price_delta=delta)), ORDERS_DDL)
        stages[_sequence_name(file_date, mode)] = tf.stamp_audit(good, file_date, RUN_TS)
    listing = spark.createDataFrame([(f"/in/{n}",) for n in stages], "path string")
    plan = dl.plan_list(dl.plan_deliveries(dl.parse_delivery_names(listing), keys="o_orderkey"))
    target = _old_orders_target(spark, sf_dir)
    deliveries = [(p["effective_mode"], stages[p["file_name"]]) for p in plan]
    return modes_mod.merge_deliveries(target, deliveries, keys="o_orderkey")


CUSTOM_SELECT = ["l_orderkey", "l_linenumber", "upper(l_returnflag) AS l_returnflag",
                 "l_extendedprice * (1 - l_discount) AS net_price", "l_shipdate"]
CUSTOM_STEPS = [
    "SELECT * FROM {stage} WHERE l_quantity > 10",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, "
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM [TABLE]",
    "SELECT * FROM [SCHEMA].[TABLE] WHERE l_returnflag = 'R'",
]


def q_custom_projection(spark, sf_dir):
    return tf.project(table(spark, sf_dir, "lineitem"), CUSTOM_SELECT)


def q_custom_steps(spark, sf_dir):
    return tf.apply_steps(spark, table(spark, sf_dir, "lineitem"), CUSTOM_STEPS)


def _profile(df, keys, name):
    return (keys_mod.key_profile(df, keys)
            .select(F.lit(name).alias("table_name"), "*")
            .withColumn("passed", F.col("n_rows") == F.col("n_keys")))


def q_duplicate_keys(spark, sf_dir):
    return _profile(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS, "lineitem").unionByName(
        _profile(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"))


def q_duplicate_key_list(spark, sf_dir):
    return keys_mod.duplicate_keys(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS)


def q_pk_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = F.when(F.expr(PK_NULL_SQL), F.lit(None)).otherwise(F.col("l_orderkey"))
    cols = [key if c == "l_orderkey" else c for c in LINEITEM_COLS]
    parsed = ts.parse_delimited(li.select(delimited_line(cols).alias("value")),
                                LINEITEM_DDL, "|")
    return keys_mod.pk_violations(ts.good_rows(parsed, LINEITEM_DDL), LINEITEM_KEYS)


def q_load_counts(spark, sf_dir):
    """Journal counts of the flagship update, as (event, value) rows."""
    parsed = _orders_update_stage(spark, sf_dir)
    lc = ts.line_counts(parsed)
    stage = tf.stamp_audit(ts.good_rows(parsed, ORDERS_DDL), NEW_FILE_DATE, RUN_TS)
    target = _old_orders_target(spark, sf_dir)
    kept = keys_mod.anti_by_key(target, stage, ["o_orderkey"])
    final = kept.unionByName(modes_mod.conform(stage, target))
    rejected = tf.where_equal(rejects_mod.rejected_rows(parsed, 7, RUN_TS), "S_ID", 7)

    def count_of(df, event):
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(event).alias("event"), "value")

    return (lc.select(F.lit("NB_Rows_input_file").alias("event"), F.col("n_lines").alias("value"))
            .unionByName(count_of(rejected, "NBRows_rejected_table"))
            .unionByName(lc.select(F.lit("NB_Rows_discard_file").alias("event"), F.col("n_discarded").alias("value")))
            .unionByName(count_of(stage, "NBRows_temp_table"))
            .unionByName(count_of(target, "NBRows_before_loading"))
            .unionByName(count_of(kept, "NBRows_table_after_delete_request"))
            .unionByName(count_of(final, "NBRows_after_loading")))


def _status_log(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("S_ID"), F.lit("SRC.BASE.EVENTS").alias("S_PROCESS"),
        F.col("event_type").alias("S_PROCESS_VALUE"),
        F.when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("S_STATUS"),
        F.col("ts").alias("TS"), F.col("event_id").alias("SEQ"))


def q_run_status(spark, sf_dir):
    return counts_mod.run_status(_status_log(spark, sf_dir))


def q_latest_run(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    runs = ev.select(F.col("event_id").alias("S_ID"), F.upper("event_type").alias("S_PROCESS"),
                     F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("S_PROCESS_VALUE"))
    return counts_mod.latest_run(runs)


SPLIT_COLUMNS = ["o_totalprice", "o_custkey", "o_orderkey"]


def q_split_target(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer

    frame, _, _, label = tf.split_target(table(spark, sf_dir, "orders"), SPLIT_COLUMNS)
    indexer = StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="frequencyDesc")
    return indexer.fit(frame).transform(frame)


OLS_Y, OLS_XS = "l_extendedprice", ["l_quantity", "l_discount"]
SIG = 8


def q_ols_simple(spark, sf_dir):
    row = table(spark, sf_dir, "lineitem").agg(*ols_mod.simple_fit_columns(OLS_Y, OLS_XS[0])).first()
    return spark.createDataFrame(
        [(ols_mod.round_sig(row["slope"], SIG), ols_mod.round_sig(row["intercept"], SIG),
          ols_mod.round_sig(row["r2"], SIG), int(row["n"]))],
        "slope double, intercept double, r2 double, n bigint")


def _ols(spark, sf_dir):
    return ols_mod.ols_fit(table(spark, sf_dir, "lineitem"), OLS_Y, OLS_XS)


def q_ols_multi(spark, sf_dir):
    fit = _ols(spark, sf_dir)
    return spark.createDataFrame([(t, ols_mod.round_sig(c, SIG)) for t, c in fit.terms()],
                                 "term string, coef double")


def q_ols_summary(spark, sf_dir):
    rows = ols_mod.ols_summary_rows(_ols(spark, sf_dir))
    return spark.createDataFrame(
        [(r["term"], ols_mod.round_sig(r["coef"], SIG), ols_mod.round_sig(r["std_err"], SIG),
          ols_mod.round_sig(r["t_value"], SIG)) for r in rows],
        "term string, coef double, std_err double, t_value double")


def q_ols_pvalues(spark, sf_dir):
    """p-values of the fit's terms, and of the same t statistics with few degrees of freedom."""
    fit = _ols(spark, sf_dir)
    degrees = ols_mod.ols_fit_stats(fit)["df_resid"]
    rows = [(r["term"], ols_mod.round_sig(r["t_value"], 6), d) for r in ols_mod.ols_summary_rows(fit) for d in (1, 5, 30, degrees)]
    found = ols_mod.p_values(spark.createDataFrame(rows, "term string, t_value double, df_resid bigint"))
    return found.withColumn("p_value", F.round("p_value", 8))


def q_ols_fit_stats(spark, sf_dir):
    s = ols_mod.ols_fit_stats(_ols(spark, sf_dir))
    vals = [ols_mod.round_sig(s[k], SIG) for k in ("r2", "adj_r2", "f_stat", "log_lik", "aic", "bic")]
    return spark.createDataFrame([(s["n"], s["df_model"], s["df_resid"], *vals)],
                                 "n bigint, df_model int, df_resid bigint, r2 double, adj_r2 double, "
                                 "f_stat double, log_lik double, aic double, bic double")


def q_ols_predict(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    fit = ols_mod.ols_fit(li, OLS_Y, OLS_XS)
    return ols_mod.ols_predict(fit, li.select("l_orderkey", "l_linenumber", *OLS_XS, OLS_Y), digits=SIG)


def q_regression_line(spark, sf_dir):
    return ols_mod.regression_line(table(spark, sf_dir, "lineitem"), OLS_Y, OLS_XS[0], steps=50, digits=SIG)


def q_logit_predict(spark, sf_dir):
    from loadwright.models import classify

    emb = table(spark, sf_dir, "embeddings")
    model = classify.logit_fit(emb, "label", "embedding")
    return classify.logit_predict(model, emb, "embedding", keep=["vec_id", "label"])


LOGIT_XS = ["x0", "x1", "x2"]


def q_logit_coefficients(spark, sf_dir):
    """Two classes on three features: log odds of the higher labels, and how many rows get their class."""
    from loadwright.models import classify

    emb = table(spark, sf_dir, "embeddings").select(
        (F.col("label") >= 5).cast("int").alias("y"), *(F.col("embedding")[i].cast("double").alias(x) for i, x in enumerate(LOGIT_XS)))
    model = classify.logit_fit(emb, "y", LOGIT_XS, max_iter=500, tol=1e-13)
    terms = spark.createDataFrame([(t, round(c, 4)) for t, c in classify.two_class_terms(model, LOGIT_XS)], "term string, coef double")
    right = classify.logit_predict(model, emb, LOGIT_XS, keep=["y"]).agg(F.count_if(F.col("y") == F.col("prediction")).alias("n"))
    return terms.unionByName(right.select(F.lit("n_right").alias("term"), F.col("n").cast("double").alias("coef")))


def _forest(spark, sf_dir):
    from loadwright.models import classify

    emb = table(spark, sf_dir, "embeddings")
    model = classify.forest_fit(emb, "label", "embedding", max_depth=8)
    return emb, model, classify.forest_nodes(spark, model)


def q_forest_node_checks(spark, sf_dir):
    from loadwright.models import classify

    return classify.node_checks(_forest(spark, sf_dir)[2])


def q_forest_score(spark, sf_dir):
    """Rows scored from the node table alone: how many agree with the fitted forest, by label."""
    from loadwright.models import classify

    emb, model, nodes = _forest(spark, sf_dir)
    own = classify.logit_predict(model, emb, "embedding", keep=["vec_id", "label", "embedding"]).withColumnRenamed("prediction", "spark_class")
    scored = classify.forest_score(nodes, own, "embedding", model.classes)
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("spark_class")).alias("n_equal"),
                                       F.sum(F.size("tree_classes")).alias("n_votes"))


def q_forest_tree_nodes(spark, sf_dir):
    from loadwright.models import classify

    emb = table(spark, sf_dir, "embeddings")
    model = classify.forest_fit(emb, "label", "embedding")
    names = classify.feature_names(emb, "embedding", model)
    return classify.tree_nodes(spark, model, classify.SHOWN_TREE, names)


def q_governed_load(spark, sf_dir):
    from loadwright.plans.scenario import governed_customer_load

    return governed_customer_load(spark, sf_dir)


def q_governed_load_bucketed(spark, sf_dir):
    from loadwright.plans.scenario import governed_customer_load

    return governed_customer_load(spark, sf_dir, buckets=8, bulk=True)


def q_governed_load_twice(spark, sf_dir):
    """The governed load run three times over the same folder: retired files never come back."""
    from loadwright.plans.scenario import governed_customer_load

    return governed_customer_load(spark, sf_dir, runs=3)


def q_governed_load_append(spark, sf_dir):
    """Two runs of deliveries without a key: each row with the segment it was written in, which later loads leave as it is."""
    from loadwright.plans.scenario import governed_customer_append

    return governed_customer_append(spark, sf_dir)


def q_governed_load_key_index(spark, sf_dir):
    """A primary key other than the delivery key, guarded through its index."""
    from loadwright.plans.scenario import governed_customer_key_index

    return governed_customer_key_index(spark, sf_dir)


def q_load_column_statistics(spark, sf_dir):
    """Merged statistics of the loaded target (its exact part; the distinct counts are estimates)."""
    from loadwright.plans.scenario import governed_customer_statistics

    return governed_customer_statistics(spark, sf_dir)


def q_governed_load_journal(spark, sf_dir):
    """Events of a governed load, but for the one that names its (unique) table."""
    from loadwright.plans.scenario import governed_customer_journal

    return governed_customer_journal(spark, sf_dir)


def q_regression_points(spark, sf_dir):
    return ols_mod.regression_points(table(spark, sf_dir, "lineitem"), OLS_Y, OLS_XS[0])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_delimited": q_parse_delimited,
    "parse_formats": q_parse_formats,
    "parse_fixed_width": q_parse_fixed_width,
    "skip_lines": q_skip_lines,
    "read_csv_inferred": q_read_csv_inferred,
    "first_rows": q_first_rows,
    "rejected_lines": q_rejected_lines,
    "discard_and_gate": q_discard_and_gate,
    "delivery_names": q_delivery_names,
    "delivery_plan": q_delivery_plan,
    "delivery_unprocessed": q_delivery_unprocessed,
    "load_full": q_load_full,
    "load_update_single": q_load_update_single,
    "load_update_composite": q_load_update_composite,
    "load_update_removed": q_load_update_removed,
    "load_insert": q_load_insert,
    "load_sequence": q_load_sequence,
    "custom_projection": q_custom_projection,
    "custom_steps": q_custom_steps,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_key_list": q_duplicate_key_list,
    "pk_violations": q_pk_violations,
    "load_counts": q_load_counts,
    "run_status": q_run_status,
    "latest_run": q_latest_run,
    "split_target": q_split_target,
    "ols_simple": q_ols_simple,
    "ols_multi": q_ols_multi,
    "ols_summary": q_ols_summary,
    "ols_pvalues": q_ols_pvalues,
    "ols_fit_stats": q_ols_fit_stats,
    "ols_predict": q_ols_predict,
    "regression_line": q_regression_line,
    "logit_predict": q_logit_predict,
    "logit_coefficients": q_logit_coefficients,
    "forest_tree_nodes": q_forest_tree_nodes,
    "forest_node_checks": q_forest_node_checks,
    "forest_score": q_forest_score,
    "governed_load": q_governed_load,
    "governed_load_bucketed": q_governed_load_bucketed,
    "governed_load_twice": q_governed_load_twice,
    "governed_load_append": q_governed_load_append,
    "governed_load_key_index": q_governed_load_key_index,
    "governed_load_journal": q_governed_load_journal,
    "load_column_statistics": q_load_column_statistics,
    "regression_points": q_regression_points,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse -> split rejects -> duplicate-key gate -> UPDT into the old snapshot."""
    parsed = _orders_update_stage(spark, sf_dir)
    stage = ts.good_rows(parsed, ORDERS_DDL)
    keys_mod.assert_unique(stage, ["o_orderkey"])
    stamped = tf.stamp_audit(stage, NEW_FILE_DATE, RUN_TS)
    return modes_mod.load_update(_old_orders_target(spark, sf_dir), stamped, ["o_orderkey"])
