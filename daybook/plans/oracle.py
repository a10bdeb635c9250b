"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from what each result *is*, not from how a run arrives at it: an incremental run's days are
the window of the full cumulative series, moved by the offset that its seed rule implies; a staging
upsert is the rows of the later batch plus the earlier rows of other orders.  Money is summed as
``DECIMAL(38,10)``, without rounding lines first, and cast to DOUBLE; statistics are rounded to 6
decimals.  Tables ``events``, ``lineitem`` and ``orders`` are views over the same Parquet files.
"""

from __future__ import annotations

EF = "2024-01-17"
LF = "2001-07-19"
L_CUT = "2001-07-26"
E_GAP = "2024-01-16"

E_TXN = """txn AS (
    SELECT event_id AS order_id, user_id AS buyer_id, CAST(ts AS DATE) AS order_date,
           ts AS order_timestamp, CAST(0 AS BIGINT) AS product_id, CAST(1 AS BIGINT) AS quantity,
           value AS unit_price, value AS revenue, event_type AS payment_method
    FROM events
)"""

L_TXN = """txn AS (
    SELECT l.l_orderkey AS order_id, o.o_custkey AS buyer_id, CAST(o.o_orderdate AS DATE) AS order_date,
           o.o_orderdate AS order_timestamp, l.l_partkey AS product_id,
           CAST(l.l_quantity AS BIGINT) AS quantity,
           CASE WHEN CAST(l.l_quantity AS BIGINT) > 0 THEN
               FLOOR((2 * CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
                     / CAST(2 * CAST(l.l_quantity AS BIGINT) AS DOUBLE)) / 100.0
           END AS unit_price,
           l.l_extendedprice AS revenue, o.o_orderpriority AS payment_method
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

STG_COLS = """CAST(order_timestamp AS DATE) AS order_date, order_id, buyer_id, order_timestamp,
           product_id, quantity, unit_price, revenue, payment_method"""


def stg(name: str, src: str = "txn", where: str = "") -> str:
    return f"{name} AS (SELECT {STG_COLS} FROM {src} {where})"


def stg1(name="stg", src="txn"):
    return stg(name, src)


def stg2(name="stg", src="txn", from_date=None):
    w = "WHERE order_timestamp IS NOT NULL"
    if from_date:
        w += f" AND CAST(order_timestamp AS DATE) >= DATE '{from_date}'"
    return stg(name, src, w)


MONEY = "CAST(SUM(CAST({c} AS DECIMAL(38,10))) AS DOUBLE)"


def daily(name: str, src: str, where: str = "") -> str:
    return f"""{name} AS (
    SELECT order_date, {MONEY.format(c='revenue')} AS daily_revenue,
           COUNT(DISTINCT order_id) AS daily_orders
    FROM {src} {where} GROUP BY order_date)"""


def series(name: str, src: str, where: str = "") -> str:
    """One row per day: exact revenue, orders, buyers, and the revenue of all days up to it."""
    return f"""{name} AS (
    SELECT *, SUM(exact) OVER (ORDER BY order_date) AS total FROM (
        SELECT order_date, SUM(CAST(revenue AS DECIMAL(38,10))) AS exact,
               COUNT(DISTINCT order_id) AS daily_orders, COUNT(DISTINCT buyer_id) AS daily_buyers
        FROM {src} {where} GROUP BY order_date))"""


def days(src: str, offset: str = "0", where: str = "") -> str:
    """The metric's columns of a series, its total moved down by ``offset``."""
    return f"""SELECT order_date, CAST(exact AS DOUBLE) AS daily_revenue, daily_orders, daily_buyers,
       CAST(total - {offset} AS DOUBLE) AS running_revenue FROM {src} {where}"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


V3_COLS = "order_date, daily_revenue, daily_orders, daily_buyers, running_revenue"


def _incremental_sql(txn: str, from_date: str, seed: str, extra_filter: str = "TRUE") -> str:
    """What an incremental run of the running total emits: the day it continues from, as stored, and
    the window's days.  ``latest`` continues from the newest earlier day, so nothing is moved;
    ``exact`` only from the calendar day before, and starts from zero where that day has no sales."""
    pre = with_(txn, f"txn2 AS (SELECT * FROM txn WHERE {extra_filter})", stg2("stg", "txn2"), series("s", "stg"))
    if seed == "latest":
        first = f"(SELECT MAX(order_date) FROM s WHERE order_date < DATE '{from_date}')"
        return pre + days("s", where=f"WHERE order_date >= COALESCE({first}, DATE '{from_date}')")
    eve = f"DATE '{from_date}' - INTERVAL 1 DAY"
    missing = (f"CASE WHEN EXISTS (SELECT 1 FROM s WHERE order_date = {eve}) THEN 0 ELSE "
               f"COALESCE((SELECT MAX(total) FROM s WHERE order_date < DATE '{from_date}'), 0) END")
    return pre + days("s", f"({missing})", f"WHERE order_date >= {eve}")


SQL: dict[str, str] = {}

SQL["stg_full"] = with_(L_TXN, stg1()) + "SELECT * FROM stg"
SQL["stg_incremental_window"] = with_(L_TXN, stg2(from_date=LF)) + "SELECT * FROM stg"
SQL["stg_delete_insert"] = with_(
    L_TXN, stg2("stg_all"),
    f"target AS (SELECT * FROM stg_all WHERE order_date < DATE '{L_CUT}')",
    f"batch AS (SELECT * FROM stg_all WHERE order_date >= DATE '{LF}')",
) + """SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM batch)
UNION ALL BY NAME
SELECT * FROM batch"""

SQL["daily_revenue_full"] = with_(L_TXN, stg1(), daily("agg", "stg")) + "SELECT * FROM agg"
SQL["daily_revenue_full_events"] = with_(E_TXN, stg1(), daily("agg", "stg")) + "SELECT * FROM agg"
SQL["daily_revenue_window"] = with_(
    L_TXN, stg2(from_date=LF), daily("agg", "stg", f"WHERE order_date >= DATE '{LF}'")) + "SELECT * FROM agg"
SQL["daily_revenue_window_events"] = with_(
    E_TXN, stg2(from_date=EF), daily("agg", "stg", f"WHERE order_date >= DATE '{EF}'")) + "SELECT * FROM agg"
SQL["daily_delete_insert"] = with_(
    E_TXN,
    "early AS (SELECT * FROM txn WHERE NOT (order_id % 10 = 0))",
    stg2("stg_early", "early"), daily("target", "stg_early"),
    stg2("stg_batch", "txn", EF), daily("batch", "stg_batch", f"WHERE order_date >= DATE '{EF}'"),
) + """SELECT * FROM target WHERE order_date NOT IN (SELECT order_date FROM batch)
UNION ALL BY NAME
SELECT * FROM batch"""

SQL["daily_running_full"] = with_(L_TXN, stg2(), series("s", "stg")) + days("s")
SQL["daily_running_full_events"] = with_(E_TXN, stg2(), series("s", "stg")) + days("s")
SQL["daily_running_incremental"] = _incremental_sql(L_TXN, LF, "exact")
SQL["daily_running_incremental_events"] = _incremental_sql(E_TXN, EF, "exact")
SQL["seed_latest_gap"] = _incremental_sql(E_TXN, EF, "latest", f"order_date <> DATE '{E_GAP}'")
SQL["seed_exact_gap"] = _incremental_sql(E_TXN, EF, "exact", f"order_date <> DATE '{E_GAP}'")

# First run without the late rows, then a run over the window once they are there: days before the
# window keep the early figures, the window's days are complete and continue the early total of the
# day before it.
_LATE = with_(
    E_TXN, "early AS (SELECT * FROM txn WHERE order_id % 10 <> 0)",
    stg2("stg_early", "early"), stg2("stg_window", "txn", EF), series("e", "stg_early"), series("w", "stg_window"))
_LATE_START = f"COALESCE((SELECT total FROM e WHERE order_date = DATE '{EF}' - INTERVAL 1 DAY), 0)"
SQL["late_in_window"] = _LATE + days("e", where=f"WHERE order_date < DATE '{EF}'") + "\nUNION ALL\n" + days("w", f"(-{_LATE_START})")
SQL["late_out_of_window"] = _LATE + """SELECT * FROM stg_window
UNION ALL
SELECT e.* FROM stg_early e LEFT JOIN (SELECT DISTINCT order_id FROM stg_window) w USING (order_id) WHERE w.order_id IS NULL"""

SQL["daily_arrow_batches"] = SQL["daily_running_full_events"]
SQL["daily_arrow_grouped"] = SQL["daily_running_full_events"]
SQL["daily_arrow_batches_lines"] = SQL["daily_running_full"]
SQL["daily_arrow_grouped_lines"] = SQL["daily_running_full"]
SQL["daily_arrow_v1_lines"] = SQL["daily_revenue_full"]
SQL["daily_arrow_v2_window"] = SQL["daily_revenue_window"]
SQL["daily_arrow_incremental"] = SQL["daily_running_incremental_events"]

SQL["union_by_name"] = with_(E_TXN, stg2(), series("s", "stg")) + f"""SELECT order_date, CAST(exact AS DOUBLE) AS daily_revenue,
       CAST(CASE WHEN order_date < DATE '{EF}' THEN total ELSE exact END AS DOUBLE) AS running_revenue
FROM s WHERE order_date >= DATE '{EF}' - INTERVAL 1 DAY"""

SQL["schema_append"] = with_(
    E_TXN, stg2(), daily("target", "stg"),
    f"""batch AS (SELECT order_date, {MONEY.format(c='revenue')} AS daily_revenue,
        COUNT(DISTINCT order_id) AS daily_orders, COUNT(DISTINCT buyer_id) AS daily_buyers
        FROM stg WHERE order_date >= DATE '{EF}' GROUP BY order_date)""",
) + """SELECT *, CAST(NULL AS BIGINT) AS daily_buyers FROM target
WHERE order_date NOT IN (SELECT order_date FROM batch)
UNION ALL BY NAME
SELECT * FROM batch"""
SQL["stored_schema_append"] = SQL["schema_append"]

_L_METRIC = with_(L_TXN, stg2(), series("s", "stg"), f"m AS ({days('s')})")
SQL["latest_30_days"] = _L_METRIC + f"SELECT {V3_COLS} FROM m ORDER BY order_date DESC LIMIT 30"
SQL["head_10"] = _L_METRIC + f"SELECT {V3_COLS} FROM m ORDER BY order_date LIMIT 10"
SQL["limit_100"] = _L_METRIC + f"SELECT {V3_COLS} FROM m ORDER BY order_date LIMIT 100"
SQL["running_series"] = _L_METRIC + "SELECT order_date, running_revenue FROM m ORDER BY order_date"
SQL["metric_overview"] = _L_METRIC + f"""SELECT COUNT(*) AS record_count, MIN(order_date) AS first_date,
    MAX(order_date) AS last_date, {MONEY.format(c='daily_revenue')} AS total_revenue,
    CAST(SUM(daily_orders) AS BIGINT) AS total_orders FROM m"""

_stats = []
for _m in ("daily_revenue", "daily_orders", "daily_buyers"):
    _stats += [f"ROUND(AVG({_m}), 6) AS mean_{_m}", f"ROUND(MEDIAN({_m}), 6) AS median_{_m}",
               f"MAX({_m}) AS max_{_m}", f"MIN({_m}) AS min_{_m}"]
SQL["metric_statistics"] = _L_METRIC + "SELECT " + ", ".join(_stats) + " FROM m"
SQL["metric_describe"] = _L_METRIC + """, longf AS (
    SELECT 'daily_revenue' AS measure, CAST(daily_revenue AS DOUBLE) AS value FROM m
    UNION ALL SELECT 'daily_orders', CAST(daily_orders AS DOUBLE) FROM m
    UNION ALL SELECT 'daily_buyers', CAST(daily_buyers AS DOUBLE) FROM m)
SELECT measure, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std,
       MIN(value) AS min, ROUND(QUANTILE_CONT(value, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(value, 0.75), 6) AS p75, MAX(value) AS max
FROM longf GROUP BY measure"""

SQL["line_statistics"] = with_(L_TXN, """longf AS (
    SELECT 'quantity' AS measure, CAST(quantity AS DOUBLE) AS value FROM txn
    UNION ALL SELECT 'unit_price', unit_price FROM txn
    UNION ALL SELECT 'revenue', revenue FROM txn)""") + """
SELECT measure, COUNT(value) AS count, ROUND(CAST(SUM(CAST(value AS DECIMAL(38,10))) AS DOUBLE) / COUNT(value), 6) AS mean,
       ROUND(STDDEV_SAMP(value), 6) AS std,
       MIN(value) AS min, ROUND(QUANTILE_CONT(value, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(value, 0.75), 6) AS p75, MAX(value) AS max
FROM longf GROUP BY measure"""

SQL["dataset_profile"] = with_(L_TXN, stg1()) + f"""SELECT COUNT(*) AS total_rows,
    COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT buyer_id) AS total_buyers,
    COUNT(DISTINCT product_id) AS total_products, {MONEY.format(c='revenue')} AS total_revenue FROM stg"""
SQL["avg_order_value"] = with_(
    L_TXN, stg1(),
    "per_order AS (SELECT order_id, SUM(CAST(ROUND(revenue * 100) AS BIGINT)) AS cents FROM stg GROUP BY order_id)",
) + "SELECT COUNT(*) AS order_count, ROUND(AVG(cents) / 100.0, 6) AS avg_order_value FROM per_order"
SQL["rows_per_day"] = with_(L_TXN, stg1()) + "SELECT order_date, COUNT(*) AS row_count FROM stg GROUP BY order_date"

_VALID = "order_timestamp IS NOT NULL AND revenue IS NOT NULL AND revenue > 0"
SQL["run_preview_source"] = with_(L_TXN) + f"""
SELECT 'stg_orders_v2' AS model, 'incremental' AS mode, DATE '{LF}' AS from_date,
       COUNT(*) AS row_count, COUNT(DISTINCT CAST(order_timestamp AS DATE)) AS day_count
FROM txn WHERE {_VALID} AND CAST(order_timestamp AS DATE) >= DATE '{LF}'
UNION ALL
SELECT 'stg_orders_v2', 'first_run', CAST(NULL AS DATE), COUNT(*), CAST(NULL AS BIGINT) FROM txn WHERE {_VALID}
UNION ALL
SELECT 'stg_orders_v1', 'full_refresh', CAST(NULL AS DATE), COUNT(*), CAST(NULL AS BIGINT) FROM txn WHERE {_VALID}"""
SQL["run_preview_staging"] = with_(L_TXN, stg1("s1"), stg2("s2")) + f"""
SELECT 'agg_daily_revenue_v3' AS model, 'incremental' AS mode, DATE '{LF}' AS from_date,
       COUNT(*) AS row_count, COUNT(DISTINCT order_date) AS day_count
FROM s2 WHERE order_date >= DATE '{LF}'
UNION ALL
SELECT 'agg_daily_revenue_v2', 'full_refresh', CAST(NULL AS DATE), COUNT(*), CAST(NULL AS BIGINT) FROM s2
UNION ALL
SELECT 'agg_daily_revenue_v1', 'full_refresh', CAST(NULL AS DATE), COUNT(*), CAST(NULL AS BIGINT) FROM s1"""

# The declared not-null columns, as the reference declares them per model.
_STAGING_NN = "order_id buyer_id order_date order_timestamp product_id quantity unit_price revenue payment_method"
_NOT_NULL = {
    "stg_orders_v1": _STAGING_NN,
    "stg_orders_v2": _STAGING_NN,
    "agg_daily_revenue_v1": "order_date daily_revenue daily_orders",
    "agg_daily_revenue_v2": "order_date daily_revenue daily_orders",
    "agg_daily_revenue_v3": "order_date daily_revenue daily_orders daily_buyers running_revenue",
    "agg_daily_revenue_py_v1": "order_date daily_revenue daily_orders",
    "agg_daily_revenue_py_v2": "order_date daily_revenue daily_orders",
    "agg_daily_revenue_py_v3": "order_date daily_revenue daily_orders daily_buyers running_revenue",
}


def _not_null(txn: str) -> str:
    tables = with_(
        txn, stg1("stg_orders_v1"), stg2("stg_orders_v2"), series("s", "stg_orders_v2"),
        daily("agg_daily_revenue_v1", "stg_orders_v1"), daily("agg_daily_revenue_v2", "stg_orders_v2"),
        f"agg_daily_revenue_v3 AS ({days('s')})", "agg_daily_revenue_py_v1 AS (SELECT * FROM agg_daily_revenue_v1)",
        "agg_daily_revenue_py_v2 AS (SELECT * FROM agg_daily_revenue_v2)",
        "agg_daily_revenue_py_v3 AS (SELECT * FROM agg_daily_revenue_v3)")
    return tables + "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM {m}"
        for m, cols in _NOT_NULL.items() for c in cols.split())


SQL["not_null_report"] = _not_null(L_TXN)
SQL["stored_not_null_report"] = _not_null(E_TXN)


def _rejected(txn: str) -> str:
    reasons = [
        ("null_order_date", "order_date IS NULL", True),
        ("null_revenue", "revenue IS NULL", True),
        ("non_positive_revenue", "revenue <= 0", True),
        ("nan_revenue", "isnan(revenue) OR isinf(revenue)", False),
        ("sub_cent_revenue", "CAST(revenue AS DECIMAL(38,10)) <> CAST(CAST(revenue AS DECIMAL(38,10)) AS DECIMAL(38,2))", False),
        ("revenue_mismatch", "CAST(ROUND(unit_price * 100) AS BIGINT) * quantity <> CAST(ROUND(revenue * 100) AS BIGINT)", False),
        ("export_rejected_total", "order_date IS NULL OR revenue IS NULL OR revenue <= 0", True),
    ]
    return with_(txn) + "\nUNION ALL\n".join(
        f"SELECT '{r}' AS reason, COUNT(*) FILTER (WHERE {c}) AS row_count, {str(b).upper()} AS rejected_by_export FROM txn"
        for r, c, b in reasons)


SQL["rejected_rows"] = _rejected(L_TXN)
SQL["rejected_rows_events"] = _rejected(E_TXN)
_EXPORTED = "order_date IS NOT NULL AND revenue IS NOT NULL AND revenue > 0"
_KEYS = """CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
    CAST(DAY(order_date) AS INTEGER) AS date"""
SQL["export_partitions"] = with_(E_TXN) + f"SELECT {_KEYS}, COUNT(*) AS row_count FROM txn WHERE {_EXPORTED} GROUP BY 1, 2, 3"
SQL["export_read_back"] = with_(E_TXN) + f"SELECT *, {_KEYS} FROM txn WHERE {_EXPORTED}"
# The second export holds the window's days only, with every third order at double revenue.
SQL["export_rerun"] = with_(E_TXN) + f"""SELECT * REPLACE (
    CASE WHEN order_date >= DATE '{EF}' AND order_id % 3 = 0 THEN revenue * 2 ELSE revenue END AS revenue), {_KEYS}
FROM txn WHERE {_EXPORTED}"""
SQL["exported_footprint"] = with_(E_TXN) + f"""SELECT {_KEYS}, COUNT(*) AS row_count, TRUE AS has_files, TRUE AS has_bytes
FROM txn WHERE {_EXPORTED} GROUP BY 1, 2, 3"""
SQL["partition_pruned_scan"] = with_(E_TXN, f"valid AS (SELECT * FROM txn WHERE {_EXPORTED})",
                                     stg2("stg", "valid", EF)) + "SELECT * FROM stg"
SQL["unaligned_partition_scan"] = SQL["partition_pruned_scan"]
SQL["zone_mapped_scan"] = with_(E_TXN, stg2("stg", "txn", EF)) + "SELECT * FROM stg"
SQL["late_row_ledger"] = with_(E_TXN) + f"""SELECT CAST(order_timestamp AS DATE) AS day,
    COUNT(*) FILTER (WHERE order_id % 10 <> 0) AS stored_rows, COUNT(*) AS source_rows,
    COUNT(*) FILTER (WHERE order_id % 10 = 0) AS dropped_rows
FROM txn WHERE CAST(order_timestamp AS DATE) < DATE '{EF}' GROUP BY 1 HAVING COUNT(*) FILTER (WHERE order_id % 10 = 0) > 0"""

SQL["misplaced_row_ledger"] = with_(E_TXN, f"""placed AS (
    SELECT order_date AS day, CASE WHEN order_id % 5 <> 0 THEN
        CASE WHEN order_id % 3 = 0 THEN CAST(order_date - INTERVAL 1 MONTH AS DATE) ELSE order_date END END AS folder
    FROM txn WHERE {_EXPORTED})""") + f"""SELECT day, COUNT(*) AS misplaced_rows,
    COUNT(*) FILTER (WHERE day >= DATE '{EF}' AND folder < DATE '{EF}') AS hidden_rows
FROM placed WHERE folder IS DISTINCT FROM day GROUP BY day"""

_FLAWED = f"""flawed AS (
    SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN CASE WHEN order_id % 11 = 0 THEN -revenue ELSE revenue END END AS revenue,
                      CASE WHEN order_id % 13 <> 0 THEN payment_method END AS payment_method)
    FROM txn WHERE order_date >= DATE '{EF}')"""
_REPORTED = {
    ("preview", "row_count"): "COUNT(*) FILTER (WHERE revenue > 0)",
    ("preview", "day_count"): "COUNT(DISTINCT order_date) FILTER (WHERE revenue > 0)",
    **{("not_null", c): f"COUNT(*) - COUNT({c})" for c in (
        "order_id", "buyer_id", "order_date", "order_timestamp", "product_id", "quantity", "unit_price", "revenue", "payment_method")},
    ("rejected", "null_order_date"): "COUNT(*) - COUNT(order_date)",
    ("rejected", "null_revenue"): "COUNT(*) - COUNT(revenue)",
    ("rejected", "non_positive_revenue"): "COUNT(*) FILTER (WHERE revenue <= 0)",
    ("rejected", "nan_revenue"): "COUNT(*) FILTER (WHERE NOT isfinite(revenue))",
    ("rejected", "sub_cent_revenue"): "COUNT(*) FILTER (WHERE CAST(revenue AS DECIMAL(38,10)) % 0.01 <> 0)",
    ("rejected", "revenue_mismatch"): "COUNT(*) FILTER (WHERE unit_price * quantity <> revenue)",
    ("rejected", "export_rejected_total"): "COUNT(*) - COUNT(*) FILTER (WHERE revenue > 0)",
}
SQL["stored_run_report"] = with_(E_TXN, _FLAWED) + "\nUNION ALL\n".join(
    f"SELECT '{report}' AS report, '{item}' AS item, {count} AS row_count FROM flawed" for (report, item), count in _REPORTED.items())

SQL["trend_series"] = _L_METRIC + f"SELECT {V3_COLS} FROM m ORDER BY order_date"
SQL["stored_run_incremental_v3"] = SQL["daily_running_full_events"]
SQL["stored_run_incremental_py_v3"] = SQL["daily_running_full_events"]
SQL["stored_run_incremental_v2"] = with_(E_TXN, stg2(), daily("agg", "stg")) + "SELECT * FROM agg"
SQL["stored_run_late_rows"] = SQL["late_in_window"]
SQL["stored_run_late_rows_staging"] = SQL["late_out_of_window"]
SQL["stored_full_refresh_v3"] = SQL["daily_running_full_events"]
SQL["stored_run_v1"] = SQL["daily_revenue_full_events"]
SQL["stored_views"] = SQL["daily_running_full_events"] + " QUALIFY row_number() OVER (ORDER BY order_date DESC) <= 7"
SQL["stored_previews"] = with_(E_TXN, stg2()) + f"""
SELECT 'stg_orders_v2' AS model, 'incremental' AS mode, DATE '{EF}' AS from_date,
       COUNT(*) AS row_count, COUNT(DISTINCT order_date) AS day_count
FROM stg WHERE revenue > 0 AND order_date >= DATE '{EF}'
UNION ALL
SELECT 'agg_daily_revenue_v3', 'incremental', DATE '{EF}', COUNT(*), COUNT(DISTINCT order_date) FROM stg WHERE order_date >= DATE '{EF}'
UNION ALL
SELECT 'agg_daily_revenue_py_v3', 'first_run', CAST(NULL AS DATE), COUNT(*), CAST(NULL AS BIGINT) FROM stg"""
SQL["default_window_run"] = SQL["daily_revenue_window_events"]
SQL["typed_empty_window"] = with_(E_TXN, stg2(), series("s", "stg")) + days("s", where="WHERE FALSE")

# The second batch re-stages the window, where every seventh order has moved back by a year (so the
# days it leaves in the window's last week may empty), and every fifth line is restated.
_MOVED = f"""moved AS (
    SELECT * REPLACE (CASE WHEN order_id % 7 = 0 THEN order_timestamp - INTERVAL 1 YEAR ELSE order_timestamp END AS order_timestamp,
                      CASE WHEN product_id % 5 = 0 THEN revenue + 1 ELSE revenue END AS revenue)
    FROM txn WHERE CAST(order_timestamp AS DATE) >= DATE '{LF}')"""
SQL["stored_upsert_lines_direct"] = with_(
    L_TXN, stg2("before", "txn"), _MOVED, stg2("batch", "moved"),
    "orders_in AS (SELECT DISTINCT order_id FROM batch)",
) + """SELECT * FROM batch
UNION ALL
SELECT b.* FROM before b LEFT JOIN orders_in o USING (order_id) WHERE o.order_id IS NULL"""
SQL["stored_upsert_lines_index"] = SQL["stored_upsert_lines_direct"]

# However the rows were batched, the metric is that of all of them.
SQL["daily_distinct_state"] = SQL["daily_running_full_events"]
