"""Expected answers of the registered queries, as DuckDB SQL on the original tables.

The scenario rules come from :mod:`loadwright.registry`, so both sides state
them once.  Column names equal the Spark outputs.
"""

from __future__ import annotations

from loadwright import registry as R

TS_FILE_OLD = R._file_ts_sql(R.OLD_FILE_DATE)
TS_FILE_NEW = R._file_ts_sql(R.NEW_FILE_DATE)
TS_RUN = R._sql_ts(R.RUN_TS)
TS_RUN_OLD = R._sql_ts(R.OLD_RUN_TS)
TARGET_BEFORE = R._sql_ts(R.TARGET_BEFORE)
DELIVERY_FROM = R._sql_ts(R.DELIVERY_FROM)


def sig(expr: str, digits: int = R.SIG) -> str:
    """Round to significant digits, as ``registry.round_sig`` does in Python."""
    return (f"(CASE WHEN ({expr}) = 0 THEN CAST(0 AS DOUBLE) ELSE "
            f"round(({expr}), {digits - 1} - CAST(floor(log10(abs({expr}))) AS INTEGER)) END)")


ORDERS_NULLIF = ("o_orderkey, o_custkey, NULLIF(o_orderstatus, '') AS o_orderstatus, o_totalprice, "
                 "o_orderdate, NULLIF(o_orderpriority, '') AS o_orderpriority")

OLD_ORDERS = f"""
  SELECT {TS_FILE_OLD} AS METADATA_TM_FILE, {TS_RUN_OLD} AS METADATA_TM_INSERT,
         o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < {TARGET_BEFORE}"""

UPDATE_STAGE = f"""
  SELECT {TS_FILE_NEW} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT,
         o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders
  WHERE o_orderdate >= {DELIVERY_FROM} AND NOT {R.BROKEN_SQL} AND NOT {R.EXTRA_SQL}"""

LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate")

LINEITEM_TARGET = f"""
  SELECT {TS_FILE_OLD} AS METADATA_TM_FILE, {TS_RUN_OLD} AS METADATA_TM_INSERT, {LINE_COLS}
  FROM lineitem WHERE l_shipdate < {TARGET_BEFORE}"""

LINEITEM_STAGE = f"""
  WITH w AS (SELECT * FROM lineitem WHERE l_shipdate >= {DELIVERY_FROM})
  SELECT {TS_FILE_NEW} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT,
         w.l_orderkey, l_partkey, l_suppkey, w.l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM w"""

ORDER_LINE = ("concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
              "{price}, CAST(o_orderdate AS VARCHAR), o_orderpriority)")

DELIVERY_NAMES = """
  SELECT '/data/v1.2/IN/' || nm AS path, nm AS file_name, mode AS load_mode, stamp AS file_date,
         upper(event_type) AS object
  FROM (
    SELECT event_type, mode, stamp,
           concat_ws('.', 'SRC', 'BASE', upper(event_type), 'J', '00', 'MFT', mode, 'ALL',
                     CAST(event_id AS VARCHAR), stamp, stamp) AS nm
    FROM (SELECT *, strftime(ts, '%Y%m%d-%H%M%S') AS stamp,
                 CASE WHEN hour(ts) = 0 THEN 'FULL' WHEN hour(ts) = 23 THEN 'PURG' ELSE 'UPDT' END AS mode
          FROM events))"""

DELIVERY_PLAN = f"""
  WITH names AS ({DELIVERY_NAMES}),
  fd AS (SELECT object, max(file_date) AS d FROM names WHERE load_mode = 'FULL' GROUP BY object),
  fn AS (SELECT n.object, fd.d, max(n.file_name) AS nm FROM names n JOIN fd
         ON n.object = fd.object AND n.file_date = fd.d WHERE n.load_mode = 'FULL' GROUP BY n.object, fd.d)
  SELECT n.* FROM names n LEFT JOIN fn ON n.object = fn.object
  WHERE (n.load_mode = 'FULL' AND n.file_name = fn.nm)
     OR (n.load_mode = 'UPDT' AND (fn.d IS NULL OR n.file_date > fn.d))"""


def _sequence_sql() -> str:
    # plan: the newest FULL, then the UPDTs dated after it (see registry.SEQUENCE)
    newest_full = max(d for d, m, *_ in R.SEQUENCE if m == "FULL")
    applied = [s for s in R.SEQUENCE if (s[1] == "FULL" and s[0] == newest_full)
               or (s[1] == "UPDT" and s[0] > newest_full)]
    parts = []
    for order, (file_date, _mode, lo, hi, delta) in enumerate(applied, start=1):
        conds = [f"NOT {R.BROKEN_SQL}"]
        if lo:
            conds.append(f"o_orderdate >= {R._sql_ts(lo)}")
        if hi:
            conds.append(f"o_orderdate < {R._sql_ts(hi)}")
        price = f"o_totalprice + {delta!r}" if delta else "o_totalprice"
        parts.append(
            f"SELECT {order} AS ord, {R._file_ts_sql(file_date)} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT, "
            f"o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, o_orderdate, o_orderpriority "
            f"FROM orders WHERE {' AND '.join(conds)}")
    union = "\n UNION ALL ".join(parts)
    return f"""
  WITH u AS ({union}),
  w AS (SELECT o_orderkey, max(ord) AS ord FROM u GROUP BY o_orderkey)
  SELECT METADATA_TM_FILE, METADATA_TM_INSERT, u.o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  FROM u JOIN w ON u.o_orderkey = w.o_orderkey AND u.ord = w.ord"""


def _profile_sql(name: str, table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
  SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
         count(*) FILTER (WHERE n > 1) AS n_dup_keys,
         CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_dup_rows,
         sum(n) = count(*) AS passed
  FROM (SELECT {k}, count(*) AS n FROM {table} GROUP BY {k})"""


OLS_MOMENTS = """
  SELECT count(*) AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
         var_pop(l_quantity) AS s11, var_pop(l_discount) AS s22, covar_pop(l_quantity, l_discount) AS s12,
         covar_pop(l_quantity, l_extendedprice) AS s1y, covar_pop(l_discount, l_extendedprice) AS s2y
  FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL"""

OLS_COEFS = f"""
  WITH m AS ({OLS_MOMENTS}),
  b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2,
               s11 * s22 - s12 * s12 AS det FROM m)
  SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM b"""

OLS_STATS = f"""
  WITH c AS ({OLS_COEFS}),
  r AS (SELECT sum((l_extendedprice - (c.b0 + c.b1 * l_quantity + c.b2 * l_discount)) *
                   (l_extendedprice - (c.b0 + c.b1 * l_quantity + c.b2 * l_discount))) AS ssr,
               sum((l_extendedprice - c.my) * (l_extendedprice - c.my)) AS sst
        FROM lineitem, c
        WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL)
  SELECT c.*, r.ssr, r.sst, r.ssr / (c.n - 3) AS s2 FROM c, r"""

OLS_SUMMARY = f"""
  WITH s AS ({OLS_STATS}),
  e AS (SELECT b0, b1, b2,
               sqrt(s2 / n * (1 + (s22 * m1 * m1 - 2 * s12 * m1 * m2 + s11 * m2 * m2) / det)) AS se0,
               sqrt(s2 * s22 / (n * det)) AS se1, sqrt(s2 * s11 / (n * det)) AS se2 FROM s)
  SELECT 'const' AS term, {sig('b0')} AS coef, {sig('se0')} AS std_err, {sig('b0 / se0')} AS t_value FROM e
  UNION ALL SELECT 'l_quantity', {sig('b1')}, {sig('se1')}, {sig('b1 / se1')} FROM e
  UNION ALL SELECT 'l_discount', {sig('b2')}, {sig('se2')}, {sig('b2 / se2')} FROM e"""

OLS_FIT_STATS = f"""
  WITH s AS ({OLS_STATS}),
  v AS (SELECT n, 1 - ssr / sst AS r2, 1 - (ssr / sst) * (n - 1) / (n - 3) AS adj_r2,
               -0.5 * n * (ln(2 * pi()) + ln(ssr / n) + 1) AS ll FROM s)
  SELECT CAST(n AS BIGINT) AS n, 2 AS df_model, CAST(n - 3 AS BIGINT) AS df_resid,
         {sig('r2')} AS r2, {sig('adj_r2')} AS adj_r2,
         {sig('(r2 / 2) / ((1 - r2) / (n - 3))')} AS f_stat, {sig('ll')} AS log_lik,
         {sig('2 * 3 - 2 * ll')} AS aic, {sig('3 * ln(n) - 2 * ll')} AS bic
  FROM v"""

# 97.5 % quantile of Student's t from the normal one, by expansion in 1 / v (v in the thousands)
_T_QUANTILE = ("z + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v ** 2) "
               "+ (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * v ** 3)")

REGRESSION_LINE = f"""
  WITH a AS (
    SELECT {sig('regr_slope(l_extendedprice, l_quantity)')} AS b1,
           {sig('regr_intercept(l_extendedprice, l_quantity)')} AS b0,
           regr_count(l_extendedprice, l_quantity) AS n,
           {sig('regr_avgx(l_extendedprice, l_quantity)')} AS mx,
           {sig('regr_sxx(l_extendedprice, l_quantity)')} AS sxx,
           {sig('(regr_syy(l_extendedprice, l_quantity) - regr_sxy(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity) / regr_sxx(l_extendedprice, l_quantity)) / (regr_count(l_extendedprice, l_quantity) - 2)')} AS s2,
           min(l_quantity) FILTER (WHERE l_extendedprice IS NOT NULL) AS x_min,
           max(l_quantity) FILTER (WHERE l_extendedprice IS NOT NULL) AS x_max
    FROM lineitem),
  g AS (SELECT CAST(step AS INTEGER) AS step,
               a.x_min + CAST(step AS DOUBLE) * (a.x_max - a.x_min) / CAST(50 AS DOUBLE) AS x, a.*
        FROM a, range(0, 51) t(step))
  SELECT step, x, y_hat, se_fit, round(y_hat - t * se_fit, 6) AS lower, round(y_hat + t * se_fit, 6) AS upper
  FROM (SELECT step, x, b0 + b1 * x AS y_hat,
               sqrt(s2 * (CAST(1 AS DOUBLE) / CAST(n AS DOUBLE) + (x - mx) * (x - mx) / sxx)) AS se_fit,
               {_T_QUANTILE} AS t
        FROM (SELECT *, CAST(n - 2 AS DOUBLE) AS v, 1.959963984540054 AS z FROM g))"""

ORACLE_SQL: dict[str, str] = {
    "parse_delimited": f"SELECT {ORDERS_NULLIF} FROM orders",
    "parse_formats": f"""
  SELECT o_orderkey,
         CASE WHEN NOT {R.BROKEN_SQL} THEN date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) END AS order_day,
         date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) AS order_time,
         CASE WHEN {R.BROKEN_SQL} THEN 'rejected' ELSE 'good' END AS status,
         CASE WHEN {R.BROKEN_SQL} THEN 'order_day: not date' END AS reason
  FROM orders""",
    "parse_fixed_width": """
  SELECT p_partkey, NULLIF(rtrim(p_name), '') AS p_name, NULLIF(rtrim(p_brand), '') AS p_brand,
         NULLIF(rtrim(p_type), '') AS p_type, p_size, p_retailprice FROM part""",
    "skip_lines": f"SELECT {ORDERS_NULLIF} FROM orders",
    "read_csv_inferred": "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "first_rows": """
  SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
  ORDER BY s_acctbal DESC, s_suppkey LIMIT 10""",
    "rejected_lines": f"""
  SELECT CAST(1 AS BIGINT) AS S_ID, {TS_RUN} AS METADATA_TM_INSERT,
         {ORDER_LINE.format(price="'" + R.BAD_PRICE + "'")} AS LINE, 'o_totalprice: not double' AS REASON
  FROM orders WHERE {R.BROKEN_SQL}
  UNION ALL
  SELECT CAST(1 AS BIGINT), {TS_RUN},
         {ORDER_LINE.format(price="CAST(o_totalprice AS VARCHAR)")} || '|extra', 'more than 6 fields'
  FROM orders WHERE {R.EXTRA_SQL}""",
    "discard_and_gate": f"""
  WITH c AS (SELECT count(*) AS n_orders, count(*) FILTER (WHERE {R.BROKEN_SQL}) AS n_broken,
                    count(*) FILTER (WHERE {R.EXTRA_SQL}) AS n_extra,
                    count(*) FILTER (WHERE {R.BLANK_SQL}) AS n_blank FROM orders)
  SELECT n_orders + n_blank AS n_lines, n_orders - n_broken - n_extra AS n_good,
         n_broken + n_extra AS n_rejected, n_blank AS n_discarded, d.delta,
         n_broken + n_extra + d.delta AS threshold, (n_broken + n_extra) < (n_broken + n_extra + d.delta) AS passed
  FROM c, (VALUES (-1), (0), (1)) d(delta)""",
    "delivery_names": f"SELECT path, file_name, load_mode, file_date FROM ({DELIVERY_NAMES})",
    "delivery_plan": f"""
  SELECT object, file_name, load_mode, file_date,
         CASE WHEN load_mode = 'FULL' THEN 'FULL' ELSE 'UPDT' END AS effective_mode
  FROM ({DELIVERY_PLAN})""",
    "delivery_unprocessed": f"""
  WITH names AS ({DELIVERY_NAMES}), plan AS ({DELIVERY_PLAN})
  SELECT path, file_name, load_mode, file_date FROM names
  WHERE NOT EXISTS (SELECT 1 FROM plan WHERE plan.path = names.path)""",
    "load_full": f"""
  SELECT {TS_FILE_NEW} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT, {ORDERS_NULLIF}
  FROM orders WHERE NOT {R.BROKEN_SQL}""",
    "load_update_single": f"""
  WITH t AS ({OLD_ORDERS}), s AS ({UPDATE_STAGE})
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM s""",
    "load_update_composite": f"""
  WITH t AS ({LINEITEM_TARGET}), s AS ({LINEITEM_STAGE})
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey
                                                      AND s.l_linenumber = t.l_linenumber)
  UNION ALL SELECT * FROM s""",
    "load_update_removed": f"""
  WITH t AS ({LINEITEM_TARGET}), s AS ({LINEITEM_STAGE})
  SELECT * FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey
                                                  AND s.l_linenumber = t.l_linenumber)""",
    "load_insert": f"""
  {OLD_ORDERS}
  UNION ALL
  SELECT {TS_FILE_NEW}, {TS_RUN}, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= {DELIVERY_FROM} AND NOT {R.BROKEN_SQL}""",
    "load_sequence": _sequence_sql(),
    "custom_projection": """
  SELECT l_orderkey, l_linenumber, upper(l_returnflag) AS l_returnflag,
         l_extendedprice * (1 - l_discount) AS net_price, l_shipdate FROM lineitem""",
    "custom_steps": """
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
  FROM lineitem WHERE l_quantity > 10 AND l_returnflag = 'R'""",
    "duplicate_keys": _profile_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])
    + " UNION ALL " + _profile_sql("orders", "orders", ["o_orderkey"]),
    "duplicate_key_list": """
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "pk_violations": f"""
  SELECT l_orderkey, l_linenumber, count(*) AS n
  FROM (SELECT CASE WHEN {R.PK_NULL_SQL} THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber FROM lineitem)
  GROUP BY l_orderkey, l_linenumber
  HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "load_counts": f"""
  WITH d AS (SELECT * FROM orders WHERE o_orderdate >= {DELIVERY_FROM}),
  t AS ({OLD_ORDERS}), s AS ({UPDATE_STAGE}),
  kept AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey))
  SELECT 'NB_Rows_input_file' AS event, (SELECT count(*) FROM d) + (SELECT count(*) FROM d WHERE {R.BLANK_SQL}) AS value
  UNION ALL SELECT 'NBRows_rejected_table', (SELECT count(*) FROM d WHERE {R.BROKEN_SQL} OR {R.EXTRA_SQL})
  UNION ALL SELECT 'NB_Rows_discard_file', (SELECT count(*) FROM d WHERE {R.BLANK_SQL})
  UNION ALL SELECT 'NBRows_temp_table', (SELECT count(*) FROM s)
  UNION ALL SELECT 'NBRows_before_loading', (SELECT count(*) FROM t)
  UNION ALL SELECT 'NBRows_table_after_delete_request', (SELECT count(*) FROM kept)
  UNION ALL SELECT 'NBRows_after_loading', (SELECT count(*) FROM kept) + (SELECT count(*) FROM s)""",
    "run_status": """
  WITH log AS (SELECT user_id AS S_ID, 'SRC.BASE.EVENTS' AS S_PROCESS, event_type AS S_PROCESS_VALUE,
                      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS S_STATUS, ts, event_id FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY S_ID ORDER BY ts DESC, event_id DESC) AS rn FROM log),
  f AS (SELECT S_ID, min(ts) AS S_INSDATE, max(ts) AS S_UPDDATE FROM log GROUP BY S_ID)
  SELECT r.S_ID, S_PROCESS, S_PROCESS_VALUE, S_STATUS, S_INSDATE, S_UPDDATE
  FROM r JOIN f ON r.S_ID = f.S_ID WHERE rn = 1""",
    "latest_run": """
  SELECT upper(event_type) AS S_PROCESS, 'user-' || CAST(user_id AS VARCHAR) AS S_PROCESS_VALUE,
         max(event_id) AS S_ID
  FROM events GROUP BY 1, 2""",
    "split_target": """
  WITH f AS (SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY o_orderpriority),
  i AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY c DESC, o_orderpriority) - 1 AS DOUBLE) AS label_index FROM f)
  SELECT o.o_totalprice, o.o_custkey, o.o_orderkey, o.o_orderpriority, i.label_index
  FROM orders o JOIN i ON o.o_orderpriority = i.o_orderpriority""",
    "ols_simple": f"""
  SELECT {sig('regr_slope(l_extendedprice, l_quantity)')} AS slope,
         {sig('regr_intercept(l_extendedprice, l_quantity)')} AS intercept,
         {sig('regr_r2(l_extendedprice, l_quantity)')} AS r2,
         CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
  FROM lineitem""",
    "ols_multi": f"""
  WITH c AS ({OLS_COEFS})
  SELECT 'const' AS term, {sig('b0')} AS coef FROM c
  UNION ALL SELECT 'l_quantity', {sig('b1')} FROM c
  UNION ALL SELECT 'l_discount', {sig('b2')} FROM c""",
    "ols_summary": OLS_SUMMARY,
    "ols_fit_stats": OLS_FIT_STATS,
    "ols_predict": f"""
  WITH c AS (SELECT {sig('b0')} AS b0, {sig('b1')} AS b1, {sig('b2')} AS b2 FROM ({OLS_COEFS}))
  SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice,
         c.b0 + c.b1 * l_quantity + c.b2 * l_discount AS prediction
  FROM lineitem, c""",
    "regression_line": REGRESSION_LINE,
}

GOVERNED_LOAD = f"""
  WITH f AS (SELECT {R._file_ts_sql('20200101-000000')} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT,
                    c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
             FROM customer WHERE c_mktsegment <> 'BUILDING'),
  u AS (SELECT {R._file_ts_sql('20200201-000000')} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT,
               c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
        FROM customer WHERE c_nationkey < 10 AND c_mktsegment <> 'MACHINERY')
  SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.c_custkey = f.c_custkey)
  UNION ALL SELECT * FROM u"""
ORACLE_SQL["governed_load"] = GOVERNED_LOAD
ORACLE_SQL["governed_load_bucketed"] = GOVERNED_LOAD
ORACLE_SQL["governed_load_twice"] = GOVERNED_LOAD

ORACLE_SQL["governed_load_append"] = f"""
  SELECT {R._file_ts_sql("20200101-000000")} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 AS segment
  FROM customer WHERE c_nationkey < 10
  UNION ALL
  SELECT {R._file_ts_sql("20200201-000000")}, {TS_RUN}, c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment, 2
  FROM customer WHERE c_nationkey >= 15 AND c_mktsegment <> 'MACHINERY'"""

ORACLE_SQL["governed_load_key_index"] = f"""
  SELECT {R._file_ts_sql("20200101-000000")} AS METADATA_TM_FILE, {TS_RUN} AS METADATA_TM_INSERT, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey BETWEEN 3 AND 9
  UNION ALL
  SELECT {R._file_ts_sql("20200301-000000")}, {TS_RUN}, c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment
  FROM customer WHERE c_nationkey < 3 OR c_nationkey >= 15"""

_STATISTICS = ("SELECT '{0}' AS column_name, count(*) AS n_rows, count(*) - count({0}) AS n_null, CAST(min({0}) AS VARCHAR) AS min_value, "
               "CAST(max({0}) AS VARCHAR) AS max_value FROM t")
ORACLE_SQL["load_column_statistics"] = f"WITH t AS ({GOVERNED_LOAD}) " + " UNION ALL ".join(
    _STATISTICS.format(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))

_NAME = "'SRC.BASE.CUSTOMER.J.00.MFT.{0}.ALL.000.{1}.{1}'"
ORACLE_SQL["governed_load_journal"] = f"""
  WITH f AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
  d AS (SELECT * FROM customer WHERE c_nationkey < 10),
  u AS (SELECT * FROM d WHERE c_mktsegment <> 'MACHINERY'),
  n AS (SELECT (SELECT count(*) FROM f) AS nf, (SELECT count(*) FROM d) AS nd, (SELECT count(*) FROM u) AS nu,
               (SELECT count(*) FROM f WHERE c_custkey NOT IN (SELECT c_custkey FROM u)) AS kept),
  e AS (SELECT unnest([
    {{'event': 'Dataloader', 'value': 'Begin'}},
    {{'event': 'File_Not_Processed', 'value': {_NAME.format("PURG", "20200301-000000")}}},
    {{'event': 'File_Not_Processed', 'value': {_NAME.format("UPDT", "20191201-000000")}}},
    {{'event': 'Input_file', 'value': {_NAME.format("FULL", "20200101-000000")}}},
    {{'event': 'NB_Rows_input_file', 'value': CAST(nf AS VARCHAR)}},
    {{'event': 'NBRows_before_loading', 'value': '0'}},
    {{'event': 'Loadmode', 'value': 'FULL'}},
    {{'event': 'NBRows_temp_table', 'value': CAST(nf AS VARCHAR)}},
    {{'event': 'NBRows_table_after_truncate', 'value': '0'}},
    {{'event': 'NBRows_table_after_loading=NBRows_temp_table', 'value': ''}},
    {{'event': 'NBRows_after_loading', 'value': CAST(nf AS VARCHAR)}},
    {{'event': 'Input_file', 'value': {_NAME.format("UPDT", "20200201-000000")}}},
    {{'event': 'NB_Rows_input_file', 'value': CAST(nd AS VARCHAR)}},
    {{'event': 'NBRows_before_loading', 'value': CAST(nf AS VARCHAR)}},
    {{'event': 'Loadmode', 'value': 'UPDT'}},
    {{'event': 'NB_Rows_bad_file', 'value': CAST(nd - nu AS VARCHAR)}},
    {{'event': 'NBRows_rejected_table', 'value': CAST(nd - nu AS VARCHAR)}},
    {{'event': 'NBRows_temp_table', 'value': CAST(nu AS VARCHAR)}},
    {{'event': 'NBRows_table_after_delete_request', 'value': CAST(kept AS VARCHAR)}},
    {{'event': 'NBRows_after_loading', 'value': CAST(kept + nu AS VARCHAR)}},
    {{'event': 'Statistics_Calculation', 'value': ''}},
    {{'event': 'Dataloader', 'value': 'End'}}]) AS x FROM n)
  SELECT x.event AS event, x.value AS value FROM e"""
ORACLE_SQL["regression_points"] = """
  SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL"""

# two-sided tail of Student's t: Simpson's rule over its density, with v / (v + t^2) = cos(a)^2
ORACLE_SQL["ols_pvalues"] = f"""
  WITH r AS ({OLS_SUMMARY}),
  q AS (SELECT term, {sig('t_value', 6)} AS t_value, CAST(unnest([1, 5, 30, (SELECT count(*) - 3 FROM lineitem)]) AS BIGINT) AS df_resid FROM r),
  a AS (SELECT *, atan(abs(t_value) / sqrt(df_resid)) AS top,
               exp(lgamma((df_resid + 1) / 2.0) - lgamma(df_resid / 2.0)) / sqrt(pi()) AS c FROM q),
  p AS (SELECT term, t_value, df_resid, top, c, s / 4000.0 * top AS ang, CASE WHEN s IN (0, 4000) THEN 1 WHEN s % 2 = 1 THEN 4 ELSE 2 END AS w
        FROM a, range(0, 4001) r(s))
  SELECT term, t_value, df_resid, round(greatest(0.0, 1 - 2 * any_value(c) * any_value(top) / 12000.0 * sum(w * cos(ang) ** (df_resid - 1))), 8) + 0.0 AS p_value
  FROM p GROUP BY term, t_value, df_resid"""


def _newton_sql(steps: int = 12) -> str:
    """Penalised logistic regression by Newton's steps, one CTE each (the penalty of the two classes' rows together)."""
    n = "(SELECT count(*) FROM d)"
    ctes = ["d AS (SELECT CASE WHEN label >= 5 THEN 1.0 ELSE 0.0 END AS y, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS x1, "
            "CAST(embedding[3] AS DOUBLE) AS x2 FROM embeddings)",
            "b0 AS (SELECT [0.0, 0.0, 0.0, 0.0] AS b)"]
    xs = ["1.0", "x0", "x1", "x2"]
    for k in range(steps):
        score = "b[1] + b[2] * x0 + b[3] * x1 + b[4] * x2"
        ridge = [f"{0 if i == 0 else 1} * 1e-5 / 2" for i in range(4)]
        g = ", ".join(f"sum({x} * (y - p)) - {r} * any_value(b[{i + 1}]) AS g{i}" for i, (x, r) in enumerate(zip(xs, ridge)))
        h = ", ".join(f"sum({xs[i]} * {xs[j]} * p * (1 - p)){' + ' + ridge[i] if i == j else ''} AS h{i}{j}" for i in range(4) for j in range(i, 4))
        ctes.append(f"s{k} AS (SELECT any_value(b) AS b, {g}, {h} FROM (SELECT d.*, b, 1 / (1 + exp(-({score}))) AS p FROM d, b{k}))")
        # elimination without pivots (the matrix is positive definite), unknowns named e<i> for the factor rows
        at = {(i, j): f"h{min(i, j)}{max(i, j)}" for i in range(4) for j in range(4)}
        prior = f"s{k}"
        for c in range(3):
            rows = ", ".join(f"{at[i, j]} - {at[i, c]} * {at[c, j]} / {at[c, c]} AS h{i}{j}" for i in range(c + 1, 4) for j in range(i, 4))
            right = ", ".join(f"g{i} - {at[i, c]} * g{c} / {at[c, c]} AS g{i}" for i in range(c + 1, 4))
            kept = ", ".join([f"h{c}{j} AS u{c}{j}" for j in range(c, 4)] + [f"g{c} AS v{c}"] + [f"u{a}{j}" for a in range(c) for j in range(a, 4)] + [f"v{a}" for a in range(c)])
            ctes.append(f"e{k}_{c} AS (SELECT b, {rows}, {right}, {kept} FROM {prior})")
            prior = f"e{k}_{c}"
        ctes.append(f"w{k} AS (SELECT *, g3 / h33 AS d3 FROM {prior})")
        ctes.append(f"x{k} AS (SELECT *, (v2 - u23 * d3) / u22 AS d2 FROM w{k})")
        ctes.append(f"y{k} AS (SELECT *, (v1 - u12 * d2 - u13 * d3) / u11 AS d1 FROM x{k})")
        ctes.append(f"b{k + 1} AS MATERIALIZED (SELECT [b[1] + (v0 - u01 * d1 - u02 * d2 - u03 * d3) / u00, b[2] + d1, b[3] + d2, b[4] + d3] AS b FROM y{k})")
    last = f"b{steps}"
    terms = " UNION ALL ".join(f"SELECT '{t}' AS term, round(b[{i + 1}], 4) + 0.0 AS coef FROM {last}" for i, t in enumerate(["const", *R.LOGIT_XS]))
    return (f"WITH {', '.join(ctes)} {terms} UNION ALL SELECT 'n_right', CAST(count(*) AS DOUBLE) FROM d, {last} "
            "WHERE (b[1] + b[2] * x0 + b[3] * x1 + b[4] * x2 > 0) = (y = 1)")


ORACLE_SQL["logit_coefficients"] = _newton_sql()
ORACLE_SQL["forest_node_checks"] = "SELECT unnest(['children', 'gini', 'links', 'parents']) AS check_name, CAST(0 AS BIGINT) AS n_bad"
ORACLE_SQL["forest_score"] = "SELECT label, count(*) AS n_rows, count(*) AS n_equal, CAST(10 * count(*) AS BIGINT) AS n_votes FROM embeddings GROUP BY label"
