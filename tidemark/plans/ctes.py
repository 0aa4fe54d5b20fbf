"""Common table expressions that restate the adapter views in plain SQL."""

TRADES = """trades AS (
  SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date,
    floor(l_extendedprice * 100 / l_quantity) / 100.0 AS px, l_quantity AS qty, l_discount, l_returnflag,
    l_orderkey * 8 + l_linenumber AS seq
  FROM lineitem)"""

BARS = TRADES + """, bars AS (
  SELECT entity, date, arg_min(px, seq) AS open, max(px) AS high, min(px) AS low, arg_max(px, seq) AS close,
    CAST(sum(qty) AS BIGINT) AS volume
  FROM trades GROUP BY entity, date)"""

SERIES = BARS + """, s AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM bars)"""

ADJ = TRADES + """, ev0 AS (
  SELECT *, row_number() OVER (PARTITION BY entity, date_trunc('quarter', date) ORDER BY date, seq) AS rn
  FROM trades WHERE l_returnflag = 'R' AND l_discount >= 0.085),
 adj_events AS (
  SELECT entity, date, CASE WHEN seq % 3 = 0 THEN 'capital_increase' ELSE 'dividend' END AS event_type,
    CASE WHEN seq % 3 = 2 THEN px END AS before_price,
    CASE WHEN seq % 3 = 2 THEN px * (1 - l_discount) END AS reference_price,
    CASE WHEN seq % 3 = 1 THEN px * l_discount ELSE 0.0 END AS cash_dividend,
    CASE WHEN seq % 3 = 1 THEN l_discount * 10 ELSE 0.0 END AS stock_dividend,
    CASE WHEN seq % 3 = 0 THEN px * 0.8 END AS subscription_price,
    CASE WHEN seq % 3 = 0 THEN l_discount * 1000 END AS subscription_rate,
    CASE WHEN seq % 3 = 2 THEN 1.02 END AS volume_factor
  FROM ev0 WHERE rn = 1)"""

CALENDAR = """calendar AS (
  SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE isodow(l_shipdate) <= 5)"""

INFO = """entity_info AS (
  SELECT s_suppkey AS entity, s_name AS name, n_name AS industry,
    CASE WHEN s_acctbal < 0 THEN DATE '2000-01-01' END AS delisting_date, s_acctbal AS balance
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

INST = """inst_long AS (
  SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
    o_orderpriority AS investor_type,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS buy,
    CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(round(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS sell
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""

REVENUE = """period_revenue AS (
  SELECT entity, date, revenue, CAST(year(date) AS INTEGER) AS revenue_year, CAST(month(date) AS INTEGER) AS revenue_month,
    CASE WHEN (entity + month(date)) % 4 <> 0
      THEN strftime(CAST(date + INTERVAL 1 MONTH AS DATE) + 9, '%Y-%m-%d') ELSE 'pending' END AS create_time
  FROM (SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
          CAST(sum(floor(l_extendedprice)) AS BIGINT) AS revenue
        FROM lineitem GROUP BY 1, 2))"""

STATEMENT = """statement_long AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date,
    CASE l_returnflag WHEN 'A' THEN 'income' WHEN 'N' THEN 'balance' ELSE 'cashflow' END AS statement_type,
    l_linestatus AS item, CAST(sum(floor(l_extendedprice)) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2, 3, 4)"""

LEVELS = """holding_levels AS (
  SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(floor((c_acctbal + 1000) / 1000) + 1 AS INTEGER) AS level,
    count(*) AS people, CAST(sum(floor(c_acctbal) + 1000) AS BIGINT) AS unit
  FROM customer GROUP BY 1, 2)"""

FACTS = """facts AS (
  SELECT user_id AS entity, CAST(ts AS DATE) AS fact_date,
    CASE k % 3 WHEN 0 THEN 'daily' WHEN 1 THEN 'monthly' ELSE 'quarterly' END AS timeframe,
    event_type AS source, CASE k % 3 WHEN 0 THEN 'GoldenCross' WHEN 1 THEN 'DeathCross' ELSE 'VolumeSpike' END AS event_kind,
    value, CAST(k % 4 + 1 AS SMALLINT) AS severity, k, event_id,
    CASE WHEN k % 5 = 0 THEN CAST(ts AS DATE) + k % 40 END AS report_date
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
