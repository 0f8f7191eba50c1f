"""SQL over the same parquet tables that says what each query must return.

Where it can, the SQL gets the answer another way than the library does: a merged
state is the latest row over all windows, a running frontier is a join with the
days before.
"""

from __future__ import annotations

# The log of one row per event, with every user as a package.
USER_LOG = """
log AS (
  SELECT event_id AS log_id, ts AS log_time, user_id AS control_id,
         concat('S', CAST(user_id % 5 AS VARCHAR)) AS suite_code,
         CASE WHEN event_type = 'signup' THEN -1
              ELSE user_id * 100 + CAST(extract(day FROM ts) AS BIGINT) END AS job_id,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS success_flag,
         CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS complete_flag,
         CASE WHEN event_type = 'error' THEN 'Copy Has ERROR: '
              WHEN event_type = 'purchase' THEN 'Has Been Completed'
              WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 'Manage Exception Has ERROR: '
              WHEN event_type = 'signup' THEN 'Manage Start'
              ELSE 'Execution Starting' END AS message_source,
         CASE WHEN event_type = 'error' THEN concat('ERR:', props)
              WHEN event_type = 'purchase' THEN concat('OK:', props)
              WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'Has Closed'
              ELSE '' END AS message,
         date_trunc('day', ts) AS window_start,
         date_trunc('day', ts) + INTERVAL 1 DAY AS window_end
  FROM events
)"""

DUE = """
due AS (
  SELECT p.control_id, p.suite_code,
         coalesce(w.watermark, TIMESTAMP '2024-01-01 00:00:00') AS window_start,
         coalesce(w.watermark, TIMESTAMP '2024-01-01 00:00:00') + INTERVAL 7 DAY AS window_end
  FROM (SELECT DISTINCT control_id, suite_code FROM log) p
  LEFT JOIN (SELECT control_id, max(window_end) AS watermark FROM log
             WHERE success_flag = 1 AND complete_flag = 1 AND job_id <> -1
             GROUP BY control_id) w ON w.control_id = p.control_id
)"""

STATUS = """
status AS (
  SELECT 'raw' AS layer, l.control_id, CAST(NULL AS VARCHAR) AS package_name, l.job_id,
         l.suite_code, l.log_time,
         CASE WHEN l.success_flag = 0 OR l.message_source LIKE '%ERROR%' THEN 'error'
              WHEN l.success_flag = 1 AND l.complete_flag = 1 THEN 'completed'
              WHEN l.message_source LIKE '%Has Closed%' OR l.message LIKE '%Has Closed%' THEN 'closed'
              ELSE 'running' END AS status
  FROM log l
  JOIN (SELECT control_id, job_id, max(log_id) AS last_id FROM log
        WHERE job_id <> -1 GROUP BY control_id, job_id) m
    ON m.control_id = l.control_id AND m.job_id = l.job_id AND m.last_id = l.log_id
)"""

# Events with the ten-day window of the month they fall into.
FEEDS = """
feeds AS (
  SELECT *, user_id % 12 AS control_id,
         CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN TIMESTAMP '2024-01-01 00:00:00'
              WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN TIMESTAMP '2024-01-11 00:00:00'
              ELSE TIMESTAMP '2024-01-21 00:00:00' END AS window_start
  FROM events
)"""

# Per day and suite: how many feeds have a day that ended well, and which.
GATE = """
outcomes AS (
  SELECT feed_id, day, arg_max(ok, event_id) AS ok FROM (
    SELECT user_id % 12 AS feed_id, date_trunc('day', ts) AS day, event_id,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS ok
    FROM events WHERE event_type IN ('purchase', 'error')) e
  GROUP BY feed_id, day
),
frontiers AS (
  SELECT p.feed_id, d.as_of, max(o.day) AS frontier
  FROM (SELECT DISTINCT user_id % 12 AS feed_id FROM events) p
  JOIN (SELECT DISTINCT date_trunc('day', ts) AS as_of FROM events) d ON true
  LEFT JOIN outcomes o ON o.feed_id = p.feed_id AND o.day <= d.as_of AND o.ok = 1
  GROUP BY p.feed_id, d.as_of
),
gate AS (
  SELECT concat('T', CAST(feed_id % 4 AS VARCHAR)) AS suite_code, CAST(as_of AS DATE) AS as_of,
         count(*) AS package_count, count(frontier) AS total_staging_success_count,
         CAST(min(frontier) AS DATE) AS summary_start_date,
         CAST(max(frontier) AS DATE) AS summary_end_date,
         CASE WHEN count(*) = count(frontier) AND min(frontier) = max(frontier)
              THEN 'S' ELSE 'C' END AS status,
         CASE WHEN count(*) = count(frontier) AND min(frontier) = max(frontier) THEN NULL
              ELSE concat('Has Closed: package count ', count(*), ', staged ', count(frontier),
                          ', start ', coalesce(strftime(min(frontier), '%Y-%m-%d'), 'none'),
                          ', end ', coalesce(strftime(max(frontier), '%Y-%m-%d'), 'none')) END AS reason
  FROM frontiers GROUP BY 1, 2
)"""

LATEST_LINE = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
LINES = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate >= TIMESTAMP '1998-06-02 00:00:00'
                               ORDER BY {LATEST_LINE}) AS rn,
         CASE WHEN l_shipdate >= TIMESTAMP '1998-06-02 00:00:00' THEN 1 ELSE 0 END AS is_source
  FROM lineitem
)"""
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _pick_line(order: str) -> str:
    """Of the at most two rows of a key, one per side, the first in ``order``."""
    return f"""WITH {LINES}
SELECT {LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS pick
  FROM ranked WHERE rn = 1) p
WHERE pick = 1"""


LATEST_USER = """SELECT user_id, ts, event_id, event_type, value FROM events
WHERE event_id IN (SELECT arg_max(event_id, ts) FROM events GROUP BY user_id)"""

ORDERS_JOINED = """FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey"""
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

# Merging under "greater than" keeps the greatest of the windows' latest values, and of equal ones
# the earliest. Every event stays in the table by month.
EXTRACTED = f"""WITH {FEEDS}
SELECT 'user_latest' AS package_name, user_id, ts, event_id, event_type, value,
       CAST(NULL AS VARCHAR) AS feed_suite, CAST(NULL AS VARCHAR) AS partition_key
FROM ({LATEST_USER}) u
UNION ALL
SELECT 'user_record' AS package_name, user_id, ts, event_id, event_type, value, NULL, NULL FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY value DESC, window_start) AS pick
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, window_start
                                     ORDER BY ts DESC, event_id DESC) AS rn FROM feeds) w
  WHERE rn = 1) r
WHERE pick = 1
UNION ALL
SELECT 'events_by_month' AS package_name, user_id, ts, event_id, event_type, value,
       concat('T', CAST(user_id % 4 AS VARCHAR)), strftime(ts, '%Y%m') FROM events"""

ORACLES = {
    "window_read": """SELECT CASE
    WHEN ts < TIMESTAMP '2024-01-08 00:00:00' THEN '2024-01-01'
    WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN '2024-01-08'
    WHEN ts < TIMESTAMP '2024-01-22 00:00:00' THEN '2024-01-15'
    WHEN ts < TIMESTAMP '2024-01-29 00:00:00' THEN '2024-01-22'
    ELSE '2024-01-29' END AS window_start, * FROM events""",
    "due_window_read": f"""WITH {USER_LOG}, {DUE}
SELECT e.*, d.control_id, d.window_start, d.window_end
FROM events e JOIN due d ON e.user_id = d.control_id
WHERE e.ts >= d.window_start AND e.ts < d.window_end""",
    "staged_batch_read": """SELECT e.*, e.user_id AS control_id, date_trunc('day', e.ts) AS window_start
FROM events e
WHERE EXISTS (SELECT 1 FROM events d WHERE d.user_id = e.user_id AND d.event_type = 'purchase'
              AND date_trunc('day', d.ts) = date_trunc('day', e.ts))""",
    "partition_range_read": """SELECT *, strftime(o_orderdate, '%Y%m') AS partition_key,
       CAST(1 AS BIGINT) AS summary_job_id
FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'""",
    "project_columns": """SELECT l_orderkey, l_linenumber AS line,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
       upper(l_returnflag) || '-' || lower(l_linestatus) AS state FROM lineitem""",
    "land_raw": f"""WITH {FEEDS}
SELECT control_id, window_start, window_start + INTERVAL 10 DAY AS window_end,
       control_id + 200 AS job_id, event_id, ts, user_id, event_type, value, props FROM feeds""",
    "landed_counts": f"""WITH {FEEDS}
SELECT control_id, window_start, window_start + INTERVAL 10 DAY AS window_end,
       count(*) AS row_inserted, min(ts) AS first_ts, max(ts) AS last_ts
FROM feeds GROUP BY 1, 2, 3""",
    "write_enriched": f"""SELECT strftime(o_orderdate, '%Y%m') AS partition_key, o_orderstatus,
       CAST(CASE WHEN strftime(o_orderdate, '%Y%m') BETWEEN '199601' AND '199603'
            THEN -count(*) ELSE count(*) END AS BIGINT) AS orders,
       CAST(sum({CENTS}) AS BIGINT) AS price_cents,
       CAST(CASE WHEN strftime(o_orderdate, '%Y%m') BETWEEN '199601' AND '199603'
            THEN 2 ELSE 1 END AS BIGINT) AS summary_job_id
FROM orders GROUP BY strftime(o_orderdate, '%Y%m'), o_orderstatus""",
    "append_log": f"""WITH {USER_LOG}
SELECT log_id, log_time, 'raw' AS layer, CAST(NULL AS VARCHAR) AS package_name, control_id, job_id,
       CAST(NULL AS TIMESTAMP) AS start_time, success_flag, complete_flag, message_source, message,
       CAST(NULL AS VARCHAR) AS message_type, suite_code, CAST(NULL AS BIGINT) AS row_inserted,
       window_start, window_end, CAST(NULL AS TIMESTAMP) AS next_start FROM log""",
    "open_table": """SELECT o.o_orderkey, strftime(o.o_orderdate, '%Y%m') AS partition_key,
       c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "partition_key": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS partition_key FROM orders",
    "result_class": """SELECT event_id AS log_id,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'complete' END AS result FROM events""",
    "dedupe_latest": f"""SELECT {LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LATEST_LINE}) AS rn
  FROM lineitem) p
WHERE rn = 1""",
    "merge_upsert": _pick_line("is_source DESC"),
    "merge_when": _pick_line("l_extendedprice DESC, is_source"),
    "merge_insert_only": _pick_line("is_source"),
    "merge_null_keys": _pick_line("is_source DESC").replace(
        "l_linenumber, l_quantity", "nullif(l_linenumber, 7) AS l_linenumber, l_quantity"
    ),
    # Latest row before the last cut where there is one, else the latest after it.
    "merge_table": f"""SELECT {LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY CASE WHEN l_shipdate < TIMESTAMP '1999-07-01 00:00:00' THEN 0 ELSE 1 END,
                    {LATEST_LINE}) AS rn
  FROM lineitem) p
WHERE rn = 1""",
    "merge_month_table": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' THEN upper(o_orderpriority)
            ELSE o_orderpriority END AS o_orderpriority,
       strftime(o_orderdate, '%Y%m') AS partition_key
FROM orders""",
    "watermarks": """SELECT user_id AS control_id, max(date_trunc('day', ts)) + INTERVAL 1 DAY AS watermark
FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
    "due_packages": f"WITH {USER_LOG}, {DUE} SELECT control_id, suite_code, window_start, window_end FROM due",
    "latest_status": f"WITH {USER_LOG}, {STATUS} SELECT * FROM status",
    "suite_rollup": f"""WITH {USER_LOG}, {STATUS}
SELECT 'raw' AS layer, suite_code, count(*) AS jobs, count(DISTINCT control_id) AS packages,
       count(CASE WHEN status = 'completed' THEN 1 END) AS completed,
       count(CASE WHEN status = 'error' THEN 1 END) AS errors,
       count(CASE WHEN status = 'closed' THEN 1 END) AS closed
FROM status GROUP BY suite_code""",
    "package_list": """SELECT suite_code, count(*) AS package_count,
       string_agg(CAST(control_id AS VARCHAR), ';' ORDER BY control_id) AS package_list
FROM (SELECT DISTINCT user_id % 12 AS control_id,
             concat('T', CAST(user_id % 4 AS VARCHAR)) AS suite_code FROM events) p
GROUP BY suite_code""",
    "log_errors": f"""WITH {USER_LOG}
SELECT log_id, log_time, 'raw' AS layer, CAST(NULL AS VARCHAR) AS package_name, control_id, job_id,
       CAST(NULL AS TIMESTAMP) AS start_time, success_flag, complete_flag, message_source, message,
       CAST(NULL AS VARCHAR) AS message_type, suite_code, CAST(NULL AS BIGINT) AS row_inserted,
       window_start, window_end, CAST(NULL AS TIMESTAMP) AS next_start FROM log
WHERE success_flag = 0 OR message_source LIKE '%ERROR%'""",
    "readiness_gate": f"WITH {GATE} SELECT * FROM gate",
    "readiness_gate_now": f"""WITH {GATE} SELECT * FROM gate
WHERE as_of = (SELECT max(g.as_of) FROM gate g WHERE g.suite_code = gate.suite_code)""",
    "enrich_orders": f"""SELECT o.o_orderkey, o.o_orderdate,
       strftime(o.o_orderdate, '%Y%m') AS partition_key, {CENTS} AS price_cents,
       c.c_name, c.c_mktsegment, n.n_name, r.r_name, CAST(7 AS BIGINT) AS summary_job_id
{ORDERS_JOINED}""",
    "enrich_monthly": f"""SELECT strftime(o.o_orderdate, '%Y%m') AS partition_key,
       n.n_name, r.r_name, c.c_mktsegment, count(*) AS orders,
       CAST(sum({CENTS}) AS BIGINT) AS price_cents, CAST(7 AS BIGINT) AS summary_job_id
{ORDERS_JOINED}
GROUP BY strftime(o.o_orderdate, '%Y%m'), n.n_name, r.r_name, c.c_mktsegment""",
    "flow_staging": f"""WITH {FEEDS}
SELECT control_id, window_start, window_start + INTERVAL 10 DAY AS window_end,
       count(*) AS row_inserted, min(ts) AS first_ts, max(ts) AS last_ts
FROM feeds GROUP BY 1, 2, 3""",
    "flow_extract": EXTRACTED,
    "flow_extract_late": EXTRACTED,
    # Three staging runs of 12 feeds, and three merge runs of three packages.
    "flow_status": """SELECT 'raw' AS layer, concat('T', CAST(user_id % 4 AS VARCHAR)) AS suite_code,
       'events' AS package_name, 'completed' AS status,
       3 * count(DISTINCT user_id % 12) AS jobs, count(DISTINCT user_id % 12) AS packages
FROM events GROUP BY 2
UNION ALL
SELECT 'ext', 'X', name, 'completed', CAST(3 AS BIGINT), CAST(1 AS BIGINT)
FROM (VALUES ('user_latest'), ('user_record'), ('events_by_month')) p(name)""",
    "flow_rollup": """SELECT 'raw' AS layer, concat('T', CAST(user_id % 4 AS VARCHAR)) AS suite_code,
       3 * count(DISTINCT user_id % 12) AS jobs, count(DISTINCT user_id % 12) AS packages,
       3 * count(DISTINCT user_id % 12) AS completed, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS closed
FROM events GROUP BY 2
UNION ALL
SELECT 'ext', 'X', CAST(9 AS BIGINT), CAST(3 AS BIGINT), CAST(9 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    # The last day that all feeds of a suite have staged, with the values that came again.
    "flow_full": """SELECT suite_code, event_type, count(*) AS n_events,
       CAST(sum(CAST(round(value * 2 * 100) AS BIGINT)) AS BIGINT) AS cents,
       '202401' AS partition_key, DATE '2024-01-30' AS summary_date
FROM (SELECT *, concat('T', CAST(user_id % 4 AS VARCHAR)) AS suite_code FROM events) e
WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
GROUP BY suite_code, event_type""",
    "flow_summary": f"""WITH {GATE},
opened AS (SELECT DISTINCT suite_code, summary_start_date AS day FROM gate WHERE status = 'S')
SELECT o.suite_code, e.event_type, count(*) AS n_events,
       CAST(sum(CAST(round(e.value * 100) AS BIGINT)) AS BIGINT) AS cents,
       strftime(o.day, '%Y%m') AS partition_key, o.day AS summary_date
FROM opened o
JOIN events e ON concat('T', CAST(e.user_id % 4 AS VARCHAR)) = o.suite_code
             AND CAST(e.ts AS DATE) = o.day
GROUP BY o.suite_code, e.event_type, o.day""",
    "stream_merge": LATEST_USER,
}
