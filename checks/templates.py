"""Enrichment SQL, as a control row would carry it."""

# Orders with everything that describes their customer.
ORDERS = """
SELECT o.o_orderkey, o.o_orderdate, o.partition_key,
       CAST(round(o.o_totalprice * 100) AS BIGINT) AS price_cents,
       c.c_name, c.c_mktsegment, n.n_name, r.r_name, CAST(:job_id AS BIGINT) AS summary_job_id
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
WHERE o.partition_key BETWEEN :from_key AND :to_key
  AND o.o_orderdate >= :start AND o.o_orderdate < :end
"""

# Orders by month and market. They are summed per customer and month before the
# join, so a customer with very many orders meets its row in one piece per month.
MONTHLY = """
WITH per_customer AS (
  SELECT o_custkey, partition_key, count(*) AS orders,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM {orders}
  WHERE partition_key BETWEEN :from_key AND :to_key
    AND o_orderdate >= :start AND o_orderdate < :end
  GROUP BY o_custkey, partition_key
)
SELECT p.partition_key, n.n_name, r.r_name, c.c_mktsegment,
       CAST(sum(p.orders) AS BIGINT) AS orders, CAST(sum(p.cents) AS BIGINT) AS price_cents,
       CAST(:job_id AS BIGINT) AS summary_job_id
FROM per_customer p
JOIN {customer} c ON c.c_custkey = p.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
GROUP BY p.partition_key, n.n_name, r.r_name, c.c_mktsegment
"""

# A suite's events of the days of every due run, by type: counted by day first, so that one scan and
# one join with the runs serve any number of them.
DAILY = """
WITH days AS (
  SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n,
         sum(CAST(round(value * 100) AS BIGINT)) AS cents
  FROM {events}
  WHERE feed_suite = '$suite'
    AND ts >= CAST(:start AS DATE) AND ts < date_add(CAST(:end AS DATE), 1)
  GROUP BY event_type, CAST(ts AS DATE)
)
SELECT r.job_id, '$suite' AS suite_code, d.event_type, CAST(sum(d.n) AS BIGINT) AS n_events,
       CAST(sum(d.cents) AS BIGINT) AS cents
FROM days d JOIN {runs} r ON d.day BETWEEN r.start_date AND r.end_date
GROUP BY r.job_id, d.event_type
"""
