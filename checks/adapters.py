"""Star-schema inputs as SQL over the given tables, for both engines.

Each adapter is one SELECT whose text is the same for Spark and DuckDB except
for the few functions of a dialect. ``$name`` stands for a given table. Raw
adapters give text columns with seeded defects (missing values, bad formats,
copies, unknown references); star adapters give clean typed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class SparkDialect:
    @staticmethod
    def text(ts: str) -> str:
        return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"

    @staticmethod
    def plus(ts: str, seconds: str) -> str:
        return f"({ts} + make_dt_interval(0, 0, 0, CAST({seconds} AS DECIMAL(18,6))))"

    @staticmethod
    def div(a: str, b: str) -> str:
        return f"({a} div {b})"


class DuckDialect:
    @staticmethod
    def text(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"

    @staticmethod
    def plus(ts: str, seconds: str) -> str:
        return f"({ts} + to_seconds({seconds}))"

    @staticmethod
    def div(a: str, b: str) -> str:
        return f"({a} // {b})"


def _s(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _two(expression: str) -> str:
    return f"lpad(CAST({expression} AS STRING), 2, '0')"


def _copies(source: str, *extra: str) -> str:
    """The whole table plus re-sent rows: ``extra`` conditions name what is sent again."""
    parts = [f"SELECT *, 0 AS copy FROM ${source}"]
    parts += [f"SELECT *, {i} AS copy FROM ${source} WHERE {c}" for i, c in enumerate(extra, 1)]
    return "(" + " UNION ALL ".join(parts) + ") b"


def _raw_customers(d) -> str:
    k = "c_custkey"
    return f"""
    SELECT 'batch/2026-02-2' || {_s('c_nationkey % 3')} || '/customers.csv' AS _file,
      CAST({k} * 2 + copy AS BIGINT) AS _order,
      CASE WHEN {k} % 97 = 5 THEN NULL WHEN {k} % 10 = 3 THEN {_s(k)} || '.0' ELSE {_s(k)} END AS customer_id,
      c_name || CASE WHEN copy = 1 THEN ' again' ELSE '' END AS full_name,
      CASE WHEN {k} % 20 = 0 THEN 'notanemail' WHEN {k} % 33 = 1 THEN NULL
           ELSE lower(replace(c_name, '#', '')) || '@example.com' END AS email,
      CASE WHEN {k} % 25 = 0 THEN 'abc12345' WHEN {k} % 25 = 1 THEN '10' || lpad({_s(k)}, 8, '0')
           WHEN {k} % 25 = 2 THEN '10' || lpad({_s(k)}, 8, '0') || '.0' WHEN {k} % 25 = 3 THEN NULL
           ELSE '010' || lpad({_s(k)}, 8, '0') END AS phone,
      CASE WHEN {k} % 40 = 3 THEN '99' WHEN {k} % 41 = 4 THEN NULL ELSE {_s('c_nationkey')} || '.0' END AS region_id,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
           WHEN 'HOUSEHOLD' THEN '4' ELSE '5' END AS segment_id,
      CASE WHEN {k} % 30 = 4 THEN 'N/A' WHEN {k} % 30 = 5 THEN '2026-02-30' WHEN {k} % 30 = 6 THEN ' Invalid '
           ELSE '2023-' || {_two(f'1 + {k} % 12')} || '-' || {_two(f'1 + {k} % 28')} END AS signup_date,
      CASE WHEN {k} % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
      '2023-05-01T08:30:00' AS created_at,
      CASE WHEN {k} % 17 = 0 THEN 'not a date' ELSE '2026-02-22 08:00:00.123456' END AS updated_at
    FROM {_copies('customer', "c_mktsegment = 'BUILDING'")}"""


def _raw_drivers(d) -> str:
    k = "p_partkey"
    return f"""
    SELECT 'batch/2026-02-2' || {_s(f'{k} % 3')} || '/drivers.csv' AS _file,
      CAST({k} * 2 + copy AS BIGINT) AS _order,
      {_s(k)} AS driver_id, p_name || CASE WHEN copy = 1 THEN ' again' ELSE '' END AS driver_name,
      CASE WHEN {k} % 31 = 0 THEN '0201234567' ELSE '011' || lpad({_s(k)}, 8, '0') END AS driver_phone,
      CASE WHEN {k} % 13 = 0 THEN '  ' ELSE ' 29' || lpad({_s(k)}, 12, '0') END AS national_id,
      {_s(f'{k} % 25')} AS region_id, 'day' AS shift, p_type AS vehicle_type, '2022-01-15' AS hire_date,
      {_s('1 + ' + d.div('p_size', '10'))} || '.' || {_s('p_size % 10')} AS rating_avg,
      CASE WHEN {k} % 37 = 0 THEN '1.5' ELSE '0.' || {_s('p_size % 10')} END AS on_time_rate,
      CASE WHEN {k} % 41 = 0 THEN '-0.5' ELSE '0.0' || {_s('p_size % 10')} END AS cancel_rate,
      CASE WHEN {k} % 43 = 0 THEN '-1' WHEN {k} % 47 = 0 THEN 'many' ELSE {_s(f'{k} * 3')} END AS completed_deliveries,
      CASE WHEN {k} % 6 = 0 THEN 'False' ELSE 'True' END AS is_active,
      '2022-01-15 00:00:00' AS created_at, '2022-01-15 00:00:00' AS updated_at
    FROM {_copies('part', "p_type = 'SMALL'")}"""


def _raw_agents(d) -> str:
    k = "s_suppkey"
    return f"""
    SELECT 'batch/2026-02-20/agents.csv' AS _file, CAST({k} AS BIGINT) AS _order,
      {_s(k)} AS agent_id, CASE WHEN {k} % 19 = 3 THEN NULL ELSE s_name END AS agent_name,
      CASE WHEN {k} % 9 = 0 THEN 'missing@domain' ELSE 'a' || {_s(k)} || '@support.org' END AS agent_email,
      CASE WHEN {k} % 14 = 0 THEN '01312345678' ELSE '012' || lpad({_s(k)}, 8, '0') END AS agent_phone,
      {_s(f'1 + {k} % 5')} AS team_id, 'senior' AS skill_level, '2021-03-04' AS hire_date,
      CASE WHEN {k} % 21 = 2 THEN '0' ELSE {_s(f'5 + {k} % 20')} END AS avg_handle_time_min,
      '0.' || {_s(f'{k} % 10')} AS resolution_rate,
      CASE WHEN {k} % 16 = 1 THEN '5.5' ELSE '4.' || {_s(f'{k} % 10')} END AS csat_score,
      'true' AS is_active, '2021-03-04' AS created_at, '2021-03-04' AS updated_at
    FROM $supplier"""


def _raw_restaurants(d) -> str:
    k = "s_suppkey"
    return f"""
    SELECT 'batch/2026-02-20/restaurants.json' AS _file, CAST({k} AS BIGINT) AS _order,
      {_s(k)} AS restaurant_id, s_name AS restaurant_name, {_s('s_nationkey')} AS region_id,
      {_s(f'1 + {k} % 25')} AS category_id, 'low' AS price_tier,
      CASE WHEN {k} % 12 = 5 THEN '6' WHEN {k} % 12 = 7 THEN '-1' ELSE '4.' || {_s(f'{k} % 10')} END AS rating_avg,
      CASE WHEN {k} % 15 = 4 THEN '0' ELSE {_s(f'10 + {k} % 30')} END AS prep_time_avg_min,
      'true' AS is_active, '2021-03-04' AS created_at, '2021-03-04' AS updated_at
    FROM $supplier"""


def _raw_orders(d) -> str:
    k = "o_orderkey"
    slot = f"{k} % 12 + CASE WHEN copy = 2 THEN 6 ELSE 0 END"
    money = _s("CAST(o_totalprice AS DECIMAL(12,2))")
    return f"""
    SELECT 'stream/2024-01-01/' || {_two(slot)} || '/orders.json' AS _file,
      CAST({k} * 4 + copy AS BIGINT) AS _order, {_two(slot)} AS slot,
      CASE WHEN {k} % 211 = 7 THEN NULL ELSE 'ord-' || {_s(k)} END AS order_id,
      CASE WHEN {k} % 50 = 0 THEN {_s('o_custkey + 100000000')} ELSE {_s('o_custkey')} END AS customer_id,
      {_s(f'{k} % (SELECT count(*) + 2 FROM $supplier)')} AS restaurant_id,
      {_s(f'({k} * 13) % (SELECT count(*) + 20 FROM $part)')} AS driver_id,
      CASE WHEN {k} % 61 = 0 THEN NULL ELSE {_s('o_custkey % 26')} END AS region_id,
      {money} AS order_amount, '15.5' AS delivery_fee, '0' AS discount_amount,
      CASE WHEN {k} % 60 = 1 THEN '-' ELSE '' END || {money} AS total_amount,
      CASE WHEN {k} % 70 = 2 THEN NULL WHEN copy = 0 THEN o_orderstatus WHEN copy = 1 THEN 'copy' ELSE 'late' END
        AS order_status,
      CASE WHEN {k} % 3 = 0 THEN 'cash' ELSE 'card' END AS payment_method,
      CASE WHEN {k} % 80 = 3 THEN 'N/A' ELSE '2024-01-' || {_two('day(o_orderdate)')} || ' 00:00:00.000000' END AS order_created_at,
      CASE WHEN {k} % 90 = 4 THEN 'invalid' ELSE '2024-01-' || {_two('day(o_orderdate)')} || ' 00:40:00.000000' END AS delivered_at
    FROM {_copies('orders', "o_orderpriority = '1-URGENT'", "o_orderpriority = '2-HIGH'")}"""


def _times(d) -> dict[str, str]:
    e = "event_id"
    return {
        "first": d.plus("ts", f"({e} * 37 % 120)"),
        "resolved": d.plus("ts", f"(({e} * 53 % 30) * 60 + {e} % 60)"),
        "first_due": d.plus("ts", "60"),
        "resolve_due": d.plus("ts", "900"),
    }


def _raw_tickets(d) -> str:
    e, t = "event_id", _times(d)
    slot = _two("hour(ts)")
    return f"""
    SELECT 'stream/2024-01-01/' || {slot} || '/tickets.csv' AS _file,
      CAST({e} * 2 + copy AS BIGINT) AS _order, {slot} AS slot,
      'tkt-' || {_s(e)} AS ticket_id,
      CASE WHEN {e} % 12 = 0 THEN 'ord-x' || {_s(e)}
           ELSE 'ord-' || {_s(f'({e} * 7) % (SELECT count(*) FROM $orders)')} END AS order_id,
      {_s('user_id')} AS customer_id, {_s(f'({e} * 3) % (SELECT count(*) + 40 FROM $part)')} AS driver_id,
      {_s(f'{e} % (SELECT count(*) + 3 FROM $supplier)')} AS restaurant_id,
      {_s(f'{e} % (SELECT count(*) + 5 FROM $supplier)')} AS agent_id,
      {_s(f'1 + {e} % 12')} AS reason_id, {_s(f'1 + {e} % 5')} AS priority_id, {_s(f'1 + {e} % 5')} AS channel_id,
      CASE WHEN {e} % 75 = 3 THEN NULL WHEN copy = 1 THEN 'Closed' ELSE 'Resolved' END AS status,
      CASE WHEN {e} % 55 = 1 THEN '-' ELSE '' END || {_s('CAST(value AS DECIMAL(10,2))')} AS refund_amount,
      {d.text('ts')} AS created_at, {d.text(t['first'])} AS first_response_at,
      CASE WHEN {e} % 50 = 0 THEN NULL ELSE {d.text(t['resolved'])} END AS resolved_at,
      {d.text(t['first_due'])} AS sla_first_due_at, {d.text(t['resolve_due'])} AS sla_resolve_due_at
    FROM {_copies('events', "event_type = 'signup'")}"""


def _raw_ticket_events(d) -> str:
    e = "event_id"
    slot = _two("hour(ts)")
    steps = (("Open", 0, "NULL", "TRUE"), ("InProgress", 30, "'Open'", "TRUE"),
             ("Resolved", 600, "'InProgress'", "TRUE"), ("Reopened", 900, "'Resolved'", "event_type = 'error'"))
    return " UNION ALL ".join(f"""
    SELECT 'stream/2024-01-01/' || {slot} || '/ticket_events.json' AS _file,
      CAST({e} * 4 + {i} AS BIGINT) AS _order, {slot} AS slot,
      'evt-' || {_s(e)} || '-{i}' AS event_id, 'tkt-' || {_s(e)} AS ticket_id,
      {_s(f'{e} % (SELECT count(*) + 5 FROM $supplier)')} AS agent_id,
      {d.text(d.plus('ts', str(seconds)))} AS event_ts, {old} AS old_status, '{new}' AS new_status,
      CAST(NULL AS STRING) AS notes
    FROM $events WHERE {sent}""" for i, (new, seconds, old, sent) in enumerate(steps))


def _star_order(d) -> str:
    return f"""
    SELECT 'ord-' || {_s('o_orderkey')} AS order_id, CAST(o_custkey AS INT) AS customer_id,
      CAST(o_custkey % 25 AS INT) AS region_id, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
      o_orderdate AS order_created_at
    FROM $orders"""


def _star_ticket(d) -> str:
    e, t = "event_id", _times(d)
    return f"""
    SELECT 'tkt-' || {_s(e)} AS ticket_id,
      'ord-' || {_s(f'({e} * 7) % (SELECT count(*) + 500 FROM $orders)')} AS order_id,
      CAST(({e} * 3) % (SELECT count(*) + 40 FROM $part) AS INT) AS driver_id,
      CAST({e} % (SELECT count(*) + 3 FROM $supplier) AS INT) AS restaurant_id,
      CAST({e} % (SELECT count(*) + 5 FROM $supplier) AS INT) AS agent_id,
      CAST(1 + {e} % 5 AS INT) AS priority_id,
      CAST(value AS DECIMAL(10,2)) AS refund_amount, ts AS created_at,
      {t['first']} AS first_response_at,
      CASE WHEN {e} % 50 = 0 THEN NULL ELSE {t['resolved']} END AS resolved_at,
      {t['first_due']} AS sla_first_due_at, {t['resolve_due']} AS sla_resolve_due_at
    FROM $events"""


def _star_ticket_event(d) -> str:
    return f"SELECT event_id, ticket_id, new_status FROM ({_raw_ticket_events(d)}) e"


STAR = {
    "dim_city": lambda d: "SELECT r_regionkey AS city_id, r_name AS city_name FROM $region",
    "dim_region": lambda d: "SELECT n_nationkey AS region_id, n_name AS region_name, n_regionkey AS city_id FROM $nation",
    "dim_category": lambda d: (
        f"SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS INT) AS category_id, p_brand AS category_name FROM $part"),
    "dim_restaurant": lambda d: (
        "SELECT CAST(s_suppkey AS INT) AS restaurant_id, s_name AS restaurant_name, s_nationkey AS region_id, "
        "CAST(1 + s_suppkey % 25 AS INT) AS category_id FROM $supplier"),
    "dim_driver": lambda d: (
        "SELECT CAST(p_partkey AS INT) AS driver_id, p_name AS driver_name, p_type AS vehicle_type, "
        "CAST((p_size % 11) AS DECIMAL(5,3)) / 10 AS on_time_rate, "
        "CAST((p_size % 5) AS DECIMAL(5,3)) / 100 AS cancel_rate FROM $part"),
    "dim_agent": lambda d: "SELECT CAST(s_suppkey AS INT) AS agent_id FROM $supplier",
    "dim_customer": lambda d: "SELECT CAST(c_custkey AS INT) AS customer_id FROM $customer",
    "dim_priority": lambda d: (
        "SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority_id, "
        "CAST(substr(o_orderpriority, 1, 1) AS INT) AS sla_first_response_min, "
        "CAST(substr(o_orderpriority, 1, 1) AS INT) * 5 AS sla_resolution_min FROM $orders"),
    "fact_order": _star_order,
    "fact_ticket": _star_ticket,
    "fact_ticket_event": _star_ticket_event,
}

RAW = {
    "customers": _raw_customers,
    "drivers": _raw_drivers,
    "agents": _raw_agents,
    "restaurants": _raw_restaurants,
    "orders": _raw_orders,
    "tickets": _raw_tickets,
    "ticket_events": _raw_ticket_events,
    "cities": lambda d: (
        f"SELECT 'batch/2026-02-20/cities.json' AS _file, CAST(r_regionkey AS BIGINT) AS _order, "
        f"{_s('r_regionkey')} AS city_id, r_name AS city_name, 'EG' AS country, 'Africa/Cairo' AS timezone FROM $region"),
    "regions": lambda d: (
        f"SELECT 'batch/2026-02-20/regions.csv' AS _file, CAST(n_nationkey AS BIGINT) AS _order, "
        f"{_s('n_nationkey')} AS region_id, n_name AS region_name, {_s('n_regionkey')} AS city_id, "
        f"{_s('10 + n_nationkey % 7')} AS delivery_base_fee FROM $nation"),
    "segments": lambda d: (
        "SELECT 'batch/2026-02-20/segments.csv' AS _file, CAST(0 AS BIGINT) AS _order, "
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3' "
        "WHEN 'HOUSEHOLD' THEN '4' ELSE '5' END AS segment_id, c_mktsegment AS segment_name, '5' AS discount_pct, "
        "'True' AS priority_support FROM (SELECT DISTINCT c_mktsegment FROM $customer) s"),
    "categories": lambda d: (
        "SELECT 'batch/2026-02-20/categories.csv' AS _file, CAST(0 AS BIGINT) AS _order, "
        "replace(p_brand, 'Brand#', '') AS category_id, p_brand AS category_name "
        "FROM (SELECT DISTINCT p_brand FROM $part) s"),
    "teams": lambda d: (
        f"SELECT 'batch/2026-02-20/teams.csv' AS _file, CAST(t AS BIGINT) AS _order, {_s('t')} AS team_id, 'team ' || {_s('t')} AS team_name "
        f"FROM (SELECT DISTINCT 1 + s_suppkey % 4 AS t FROM $supplier) s"),
    "reason_categories": lambda d: (
        f"SELECT 'batch/2026-02-20/reason_categories.csv' AS _file, CAST(r_regionkey AS BIGINT) AS _order, "
        f"{_s('r_regionkey')} AS reason_category_id, r_name AS category_name FROM $region"),
    "reasons": lambda d: (
        f"SELECT 'batch/2026-02-20/reasons.csv' AS _file, CAST(n_nationkey AS BIGINT) AS _order, {_s('n_nationkey + 1')} AS reason_id, "
        f"n_name AS reason_name, {_s('CASE WHEN n_nationkey % 10 = 6 THEN 77 ELSE n_regionkey END')} AS reason_category_id, "
        f"{_s('CASE WHEN n_nationkey % 10 = 9 THEN 7 ELSE 1 + n_nationkey % 5 END')} AS severity_level, '0.5' AS typical_refund_pct FROM $nation"),
    "channels": lambda d: (
        f"SELECT 'batch/2026-02-20/channels.csv' AS _file, CAST(r_regionkey AS BIGINT) AS _order, {_s('r_regionkey + 1')} AS channel_id, "
        f"CASE WHEN r_regionkey = 3 THEN '' ELSE r_name END AS channel_name FROM $region"),
    "priorities": lambda d: (
        "SELECT 'batch/2026-02-20/priorities.csv' AS _file, CAST(0 AS BIGINT) AS _order, substr(p, 1, 1) AS priority_id, "
        "'P' || substr(p, 1, 1) AS priority_code, substr(p, 3) AS priority_name, substr(p, 1, 1) AS sla_first_response_min, "
        "'15' AS sla_resolution_min FROM (SELECT DISTINCT o_orderpriority AS p FROM $orders) s"),
}


def duck(name: str) -> str:
    """The adapter as DuckDB text over the registered views."""
    text = (RAW.get(name) or STAR[name])(DuckDialect)
    for source in SOURCES:
        text = text.replace(f"${source}", source)
    return text


def spark_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter as a DataFrame over the parquet tables."""
    text = (RAW.get(name) or STAR[name])(SparkDialect)
    tables = {}
    for source in SOURCES:
        if f"${source}" in text:
            text = text.replace(f"${source}", "{" + source + "}")
            tables[source] = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(text, **tables)
