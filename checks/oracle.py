"""The expected result of each query as DuckDB SQL, written independently."""

from __future__ import annotations

from checks.adapters import duck
from checks.catalog import _BATCH_TABLES, BAD_LINE, RUN_DATE, RUN_TIME
from ordergate.registry import TABLES, declared_references

SQL: dict[str, str] = {}

TS = "'%Y-%m-%d %H:%M:%S.%f'"
RUN_TS = f"{RUN_TIME}.000000"

NUMBERS = {
    "customers": ("customer_id", "region_id", "segment_id"),
    "drivers": ("driver_id", "region_id", "rating_avg", "on_time_rate", "cancel_rate", "completed_deliveries"),
    "agents": ("agent_id", "team_id", "avg_handle_time_min", "resolution_rate", "csat_score"),
    "orders": ("customer_id", "restaurant_id", "driver_id", "region_id", "order_amount", "delivery_fee",
               "discount_amount", "total_amount"),
    "tickets": ("customer_id", "driver_id", "restaurant_id", "agent_id", "reason_id", "priority_id", "channel_id",
                "refund_amount"),
    "ticket_events": ("agent_id",),
    "cities": ("city_id",),
    "regions": ("region_id", "city_id", "delivery_base_fee"),
    "segments": ("segment_id", "discount_pct"),
    "categories": ("category_id",),
    "teams": ("team_id",),
    "reason_categories": ("reason_category_id",),
    "reasons": ("reason_id", "reason_category_id", "severity_level", "typical_refund_pct"),
    "channels": ("channel_id",),
    "priorities": ("priority_id", "sla_first_response_min", "sla_resolution_min"),
    "restaurants": ("restaurant_id", "region_id", "category_id", "rating_avg", "prep_time_avg_min"),
}
DATES = {
    "customers": ("signup_date", "created_at", "updated_at"),
    "drivers": ("hire_date", "created_at", "updated_at"),
    "agents": ("hire_date", "created_at", "updated_at"),
    "orders": ("order_created_at", "delivered_at"),
    "tickets": ("created_at", "first_response_at", "resolved_at", "sla_first_due_at", "sla_resolve_due_at"),
    "ticket_events": ("event_ts",),
}
KEYS = {
    "cities": "city_id", "regions": "region_id", "segments": "segment_id", "categories": "category_id", "teams": "team_id",
    "reason_categories": "reason_category_id", "reasons": "reason_id", "channels": "channel_id", "priorities": "priority_id",
    "customers": "customer_id", "restaurants": "restaurant_id", "drivers": "driver_id", "agents": "agent_id",
    "orders": "order_id", "tickets": "ticket_id", "ticket_events": "event_id",
}

PHONE = ("CASE WHEN regexp_matches(regexp_replace(trim({c}), '^([0-9]+)[.]0$', '\\1'), '^[0-9]{{10}}$') "
         "THEN '0' || regexp_replace(trim({c}), '^([0-9]+)[.]0$', '\\1') "
         "ELSE regexp_replace(trim({c}), '^([0-9]+)[.]0$', '\\1') END")
GOOD_PHONE = "regexp_matches(" + PHONE + ", '^01[0125][0-9]{{8}}$')"
GOOD_EMAIL = "regexp_matches({c}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{{2,}}$')"

LABELS = {
    "customers": f"""CASE WHEN customer_id IS NULL THEN 'null_violation'
        WHEN NOT {GOOD_EMAIL.format(c='email')} THEN 'invalid_email:email'
        WHEN NOT {GOOD_PHONE.format(c='phone')} THEN 'invalid_phone:phone' END""",
    "orders": """CASE WHEN order_id IS NULL OR customer_id IS NULL OR restaurant_id IS NULL OR driver_id IS NULL
          OR order_status IS NULL OR order_created_at IS NULL THEN 'null_violation'
        WHEN order_amount < 0 THEN 'range_violation:order_amount' WHEN delivery_fee < 0 THEN 'range_violation:delivery_fee'
        WHEN discount_amount < 0 THEN 'range_violation:discount_amount'
        WHEN total_amount < 0 THEN 'range_violation:total_amount' END""",
    "tickets": """CASE WHEN ticket_id IS NULL OR order_id IS NULL OR agent_id IS NULL OR status IS NULL
          OR created_at IS NULL THEN 'null_violation' WHEN refund_amount < 0 THEN 'range_violation:refund_amount' END""",
    "ticket_events": """CASE WHEN event_id IS NULL OR ticket_id IS NULL OR agent_id IS NULL OR event_ts IS NULL
          OR new_status IS NULL THEN 'null_violation' END""",
    "cities": "CASE WHEN nullif(city_name, '') IS NULL THEN 'null_violation' END",
    "regions": """CASE WHEN nullif(region_name, '') IS NULL OR city_id IS NULL THEN 'null_violation'
        WHEN delivery_base_fee < 0 THEN 'range_violation:delivery_base_fee' END""",
    "segments": "CASE WHEN nullif(segment_name, '') IS NULL THEN 'null_violation' END",
    "categories": "CASE WHEN nullif(category_name, '') IS NULL THEN 'null_violation' END",
    "teams": "CASE WHEN nullif(team_name, '') IS NULL THEN 'null_violation' END",
    "reason_categories": "CASE WHEN nullif(category_name, '') IS NULL THEN 'null_violation' END",
    "reasons": """CASE WHEN nullif(reason_name, '') IS NULL OR reason_category_id IS NULL THEN 'null_violation'
        WHEN severity_level < 1 OR severity_level > 5 THEN 'range_violation:severity_level'
        WHEN typical_refund_pct < 0 OR typical_refund_pct > 1 THEN 'range_violation:typical_refund_pct' END""",
    "channels": "CASE WHEN nullif(channel_name, '') IS NULL THEN 'null_violation' END",
    "priorities": "CASE WHEN nullif(priority_name, '') IS NULL THEN 'null_violation' END",
    "restaurants": """CASE WHEN rating_avg < 1 OR rating_avg > 5 THEN 'range_violation:rating_avg'
        WHEN prep_time_avg_min < 1 THEN 'range_violation:prep_time_avg_min' END""",
    "drivers": f"""CASE WHEN NOT {GOOD_PHONE.format(c='driver_phone')} THEN 'invalid_phone:driver_phone'
        WHEN rating_avg < 1 OR rating_avg > 5 THEN 'range_violation:rating_avg'
        WHEN on_time_rate < 0 OR on_time_rate > 1 THEN 'range_violation:on_time_rate'
        WHEN cancel_rate < 0 OR cancel_rate > 1 THEN 'range_violation:cancel_rate'
        WHEN completed_deliveries < 0 THEN 'range_violation:completed_deliveries' END""",
    "agents": f"""CASE WHEN nullif(agent_name, '') IS NULL THEN 'null_violation'
        WHEN NOT {GOOD_EMAIL.format(c='agent_email')} THEN 'invalid_email:agent_email'
        WHEN NOT {GOOD_PHONE.format(c='agent_phone')} THEN 'invalid_phone:agent_phone'
        WHEN resolution_rate < 0 OR resolution_rate > 1 THEN 'range_violation:resolution_rate'
        WHEN csat_score < 1 OR csat_score > 5 THEN 'range_violation:csat_score'
        WHEN avg_handle_time_min < 1 THEN 'range_violation:avg_handle_time_min' END""",
}


def coerced(name: str) -> str:
    replaced = [f"TRY_CAST(trim({c}) AS DOUBLE) AS {c}" for c in NUMBERS.get(name, ())]
    replaced += [f"TRY_CAST(trim({c}) AS TIMESTAMP) AS {c}" for c in DATES.get(name, ())]
    return f"SELECT * REPLACE ({', '.join(replaced)}) FROM ({duck(name)}) raw"


def collapsed(name: str) -> str:
    """First copy per file and key with the number of copies; NULL keys stay as one row."""
    key = KEYS[name]
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY _file, {key} ORDER BY _order) AS rn,
          count(*) OVER (PARTITION BY _file, {key}) AS copies FROM ({coerced(name)}) c) d WHERE rn = 1"""


def labelled(name: str) -> str:
    key = KEYS[name]
    return f"""SELECT *, CASE WHEN {key} IS NOT NULL THEN {LABELS[name]} END AS reject,
        {key} IS NOT NULL AS keyed FROM ({collapsed(name)}) k"""


def valid(name: str) -> str:
    return f"SELECT * FROM ({labelled(name)}) l WHERE keyed AND reject IS NULL"


def as_text(name: str, columns: list[str] | None = None) -> str:
    from ordergate.registry import TABLES

    dates = DATES.get(name, ())
    return ", ".join(
        f"strftime({c}, {TS}) AS {c}" if c in dates else c for c in columns or TABLES[name].column_names)


ORDER_ORPHAN = """CASE
    WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'orphan_customer'
    WHEN restaurant_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'orphan_restaurant'
    WHEN driver_id NOT IN (SELECT p_partkey FROM part) THEN 'orphan_driver'
    WHEN region_id IS NULL OR region_id NOT IN (SELECT n_nationkey FROM nation) THEN 'orphan_region' END"""
TICKET_ORPHAN = """CASE
    WHEN order_id NOT IN (SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) FROM orders) THEN 'orphan_order'
    WHEN agent_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'orphan_agent' END"""
EVENT_ORPHAN = """CASE
    WHEN ticket_id NOT IN (SELECT 'tkt-' || CAST(event_id AS VARCHAR) FROM events) THEN 'orphan_ticket'
    WHEN agent_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'orphan_agent' END"""


def tested(name: str) -> str:
    label = {"orders": ORDER_ORPHAN, "tickets": TICKET_ORPHAN, "ticket_events": EVENT_ORPHAN}[name]
    return f"SELECT *, {label} AS orphan FROM ({valid(name)}) v"


def pct(s: str, n: str) -> str:
    return f"CASE WHEN {n} <> 0 THEN ((20000 * {s} + {n}) // (2 * {n})) / 100.0 END"


FLAGGED = f"""SELECT *,
    CASE WHEN known THEN first_response_at > sla_first_due_at END AS fr,
    CASE WHEN known THEN resolved_at > sla_resolve_due_at END AS res,
    CASE WHEN known THEN CAST(round(CAST(epoch_us(first_response_at) - epoch_us(created_at) AS DECIMAL(20,0)) / 1000000) AS BIGINT) END AS frs,
    CASE WHEN known THEN ((epoch_us(resolved_at) - epoch_us(created_at)) * 2 + 600000) // 1200000 END AS hundredths
  FROM (SELECT *, first_response_at IS NOT NULL AND resolved_at IS NOT NULL AND sla_first_due_at IS NOT NULL
          AND sla_resolve_due_at IS NOT NULL AS known FROM ({duck('fact_ticket')}) t) k"""

FLAGGED_COLUMNS = """ticket_id, fr AS is_first_response_breached, res AS is_resolution_breached,
    frs AS first_response_seconds, CAST(hundredths / 100.0 AS DOUBLE) AS resolution_minutes"""

REFUNDS = "CAST(sum(refund_amount) AS DOUBLE) AS total_refunds"
COUNT_RES = "count(CASE WHEN res THEN 1 END)"
COUNT_FR = "count(CASE WHEN fr THEN 1 END)"

SLA_DAILY = f"""SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, count(*) AS total_tickets,
    {COUNT_FR} AS fr_breaches, {pct(COUNT_FR, 'count(*)')} AS fr_breach_rate_pct,
    {COUNT_RES} AS res_breaches, {pct(COUNT_RES, 'count(res)')} AS res_breach_rate_pct,
    CAST((20 * sum(frs) + count(frs)) // (2 * count(frs)) AS BIGINT) / 10.0 AS avg_first_response_sec,
    CAST((2 * sum(hundredths) + count(hundredths)) // (2 * count(hundredths)) AS BIGINT) / 100.0 AS avg_resolution_min,
    {REFUNDS}, count(DISTINCT agent_id) AS agents_involved
  FROM ({FLAGGED}) f WHERE fr IS NOT NULL GROUP BY 1"""

BY_RESTAURANT = f"""SELECT CAST(r.restaurant_id AS BIGINT) AS restaurant_id, r.restaurant_name, c.category_name, g.region_name,
    count(ticket_id) AS total_tickets, {pct(COUNT_RES, 'count(res)')} AS res_breach_rate_pct,
    CAST((2 * sum(hundredths) + count(hundredths)) // (2 * count(hundredths)) AS BIGINT) / 100.0 AS avg_resolution_min,
    {REFUNDS}
  FROM ({FLAGGED}) t JOIN ({duck('dim_restaurant')}) r ON t.restaurant_id = r.restaurant_id
  JOIN ({duck('dim_category')}) c ON r.category_id = c.category_id
  JOIN ({duck('dim_region')}) g ON r.region_id = g.region_id
  WHERE res IS NOT NULL GROUP BY 1, 2, 3, 4"""

BY_DRIVER = f"""SELECT CAST(d.driver_id AS BIGINT) AS driver_id, d.driver_name, d.vehicle_type, count(ticket_id) AS total_tickets,
    {pct(COUNT_RES, 'count(res)')} AS res_breach_rate_pct, {REFUNDS},
    CAST(d.on_time_rate AS DOUBLE) AS on_time_rate, CAST(d.cancel_rate AS DOUBLE) AS cancel_rate
  FROM ({FLAGGED}) t JOIN ({duck('dim_driver')}) d ON t.driver_id = d.driver_id
  WHERE res IS NOT NULL GROUP BY 1, 2, 3, d.on_time_rate, d.cancel_rate"""

SQL["v_sla_daily"] = SLA_DAILY
SQL["v_sla_by_restaurant"] = BY_RESTAURANT
SQL["v_sla_by_driver"] = BY_DRIVER
SQL["v_sla_by_region"] = f"""SELECT c.city_name, g.region_name, count(ticket_id) AS total_tickets,
    {pct(COUNT_FR, 'count(fr)')} AS fr_breach_rate_pct, {pct(COUNT_RES, 'count(res)')} AS res_breach_rate_pct, {REFUNDS}
  FROM ({FLAGGED}) t JOIN ({duck('fact_order')}) o ON t.order_id = o.order_id
  JOIN ({duck('dim_region')}) g ON o.region_id = g.region_id JOIN ({duck('dim_city')}) c ON g.city_id = c.city_id
  WHERE res IS NOT NULL GROUP BY 1, 2"""
_REVENUE = "CAST(sum(o.total_amount) * 100 AS HUGEINT)"
SQL["v_revenue_impact"] = f"""SELECT CAST(CAST(t.created_at AS DATE) AS VARCHAR) AS day, count(t.ticket_id) AS total_tickets,
    {REFUNDS}, count(o.order_id) AS total_orders, CAST(sum(o.total_amount) AS DOUBLE) AS total_revenue,
    CAST((20000 * CAST(sum(refund_amount) * 100 AS HUGEINT) + {_REVENUE}) // (2 * {_REVENUE}) AS BIGINT) / 100.0
      AS refund_pct_of_revenue,
    ((200000 * count(t.ticket_id) + count(o.order_id)) // (2 * count(o.order_id))) / 100.0 AS complaint_rate_per_1000_orders
  FROM ({FLAGGED}) t JOIN ({duck('fact_order')}) o ON t.order_id = o.order_id GROUP BY 1"""
_REOPENED = "count(DISTINCT CASE WHEN e.new_status = 'Reopened' THEN e.ticket_id END)"
SQL["v_reopen_rate"] = f"""SELECT CAST(CAST(t.created_at AS DATE) AS VARCHAR) AS day,
    count(DISTINCT t.ticket_id) AS total_tickets, {_REOPENED} AS reopened_tickets,
    {pct(_REOPENED, 'count(DISTINCT t.ticket_id)')} AS reopen_rate_pct
  FROM ({FLAGGED}) t LEFT JOIN ({duck('fact_ticket_event')}) e ON t.ticket_id = e.ticket_id GROUP BY 1"""
SQL["sla_summary_day"] = f"SELECT * FROM ({SLA_DAILY}) v WHERE day = '2024-01-15'"
SQL["sla_health_7"] = f"SELECT * FROM ({SLA_DAILY}) v ORDER BY day DESC LIMIT 7"
SQL["top_refund_restaurants"] = f"""SELECT restaurant_name, total_refunds, res_breach_rate_pct FROM ({BY_RESTAURANT}) v
  ORDER BY total_refunds DESC, restaurant_id LIMIT 10"""
SQL["worst_drivers"] = f"""SELECT driver_name, vehicle_type, total_tickets, res_breach_rate_pct FROM ({BY_DRIVER}) v
  WHERE total_tickets >= 5 ORDER BY res_breach_rate_pct DESC, driver_id LIMIT 10"""
SQL["sla_by_restaurant_10"] = f"SELECT * FROM ({BY_RESTAURANT}) v ORDER BY res_breach_rate_pct DESC, restaurant_id LIMIT 10"
SQL["warehouse_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS rows FROM ({duck(t)}) x"
    for t in ("dim_customer", "dim_restaurant", "dim_driver", "fact_order", "fact_ticket", "fact_ticket_event"))
SQL["known_ids_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(DISTINCT {k}) AS rows FROM ({duck(t)}) x" for t, k in (
        ("dim_customer", "customer_id"), ("dim_restaurant", "restaurant_id"), ("dim_driver", "driver_id"),
        ("dim_region", "region_id"), ("dim_agent", "agent_id"), ("fact_order", "order_id"), ("fact_ticket", "ticket_id")))

SQL["sla_flags"] = f"SELECT {FLAGGED_COLUMNS} FROM ({FLAGGED}) f"
SQL["sla_flags_incremental"] = f"""SELECT ticket_id,
    CASE WHEN old THEN TRUE ELSE fr END AS is_first_response_breached,
    CASE WHEN old THEN FALSE ELSE res END AS is_resolution_breached,
    CASE WHEN old THEN -1 ELSE frs END AS first_response_seconds,
    CASE WHEN old THEN 0.0 ELSE CAST(hundredths / 100.0 AS DOUBLE) END AS resolution_minutes,
    FALSE AS still_due
  FROM (SELECT *, created_at < TIMESTAMP '2024-01-16' AS old FROM ({FLAGGED}) f) o"""
SQL["sla_due_times"] = f"""SELECT ticket_id,
    strftime(created_at + to_minutes(coalesce(p.sla_first_response_min, 1)), {TS}) AS sla_first_due_at,
    strftime(created_at + to_minutes(coalesce(p.sla_resolution_min, 15)), {TS}) AS sla_resolve_due_at
  FROM ({duck('fact_ticket')}) t LEFT JOIN ({duck('dim_priority')}) p ON t.priority_id = p.priority_id"""

# Coercion and rules
SQL["na_sentinels"] = """SELECT p_partkey, CASE WHEN p_size <= 19 THEN NULL WHEN p_size = 20 THEN ' ' WHEN p_size = 21 THEN 'nUll' WHEN p_size = 22 THEN 'N/a' ELSE p_name END AS cell FROM part"""
SQL["schema_prune"] = f"SELECT {as_text('customers')} FROM ({coerced('customers')}) c"
SQL["coerce_numeric"] = f"""SELECT driver_id, region_id, rating_avg, on_time_rate, cancel_rate, completed_deliveries
  FROM ({coerced('drivers')}) c"""
SQL["coerce_datetime"] = f"SELECT _order, {as_text('customers', ['signup_date', 'created_at', 'updated_at'])} FROM ({coerced('customers')}) c"
SQL["date_validity"] = f"""SELECT _order, signup_date IS NOT NULL AS valid_ts, signup_date IS NOT NULL AS valid_date,
    CAST(CAST(signup_date AS DATE) AS VARCHAR) AS parsed FROM ({coerced('customers')}) c"""
SQL["drop_null_pk"] = f"SELECT _file, count(*) AS rows FROM ({coerced('orders')}) c WHERE order_id IS NOT NULL GROUP BY 1"
SQL["warehouse_cast"] = f"""SELECT _order, CAST(driver_id AS BIGINT) AS driver_id, CAST(CAST(hire_date AS DATE) AS VARCHAR) AS hire_date,
    CAST(CAST(rating_avg AS DECIMAL(3,2)) AS DOUBLE) AS rating_avg, CAST(CAST(on_time_rate AS DECIMAL(5,3)) AS DOUBLE) AS on_time_rate,
    CAST(completed_deliveries AS BIGINT) AS completed_deliveries, CAST(is_active AS BOOLEAN) AS is_active
  FROM ({coerced('drivers')}) c"""
SQL["pii_mask_customers"] = f"""SELECT _order, customer_id, sha256(email) AS email_hash, sha256({PHONE.format(c='phone')}) AS phone_hash
  FROM ({coerced('customers')}) c"""
SQL["pii_mask_agents"] = f"""SELECT agent_id, sha256(agent_email) AS email_hash, sha256(agent_phone) AS phone_hash
  FROM ({coerced('agents')}) c"""
SQL["pii_mask_drivers"] = f"""SELECT _order, driver_id, sha256({PHONE.format(c='driver_phone')}) AS phone_hash,
    CASE WHEN trim(national_id) <> '' THEN sha256(trim(national_id)) END AS national_id_hash FROM ({coerced('drivers')}) c"""
SQL["quarantine_annotate"] = f"""SELECT _order, 'data_validation' AS rejection_reason, reject AS rejection_detail,
    '{RUN_TIME}' AS rejection_timestamp, _file AS source_file FROM ({labelled('customers')}) l WHERE reject IS NOT NULL"""
SQL["quarantine_roundtrip"] = f"""SELECT _order AS row_id, '{RUN_DATE}' AS run_date, 'customers' AS table_name,
    'data_validation' AS reason, reject AS rejection_detail, _file AS source_file
  FROM ({labelled('customers')}) l WHERE reject IS NOT NULL"""
SQL["dedup_keep_first"] = f"""SELECT order_id, l_quantity, l_extendedprice, strftime(l_shipdate, {TS}) AS l_shipdate FROM (
    SELECT l_orderkey || '-' || l_linenumber AS order_id, l_quantity, l_extendedprice, l_shipdate,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_discount, l_extendedprice, l_linestatus, l_partkey,
        l_quantity, l_returnflag, l_shipdate, l_suppkey, l_tax) AS rn FROM lineitem) x WHERE rn = 1"""
SQL["dedup_stats"] = f"""SELECT _file, count(*) AS total, count(*) - count(DISTINCT order_id) AS duplicates_removed,
    count(DISTINCT order_id) AS kept FROM ({coerced('orders')}) c GROUP BY 1"""
SQL["null_enforcement"] = f"SELECT _file, order_id FROM ({labelled('orders')}) l WHERE keyed AND reject = 'null_violation'"
SQL["email_format"] = f"SELECT _order, email FROM ({duck('customers')}) c WHERE NOT {GOOD_EMAIL.format(c='email')}"
SQL["phone_normalize"] = f"SELECT _order, {PHONE.format(c='phone')} AS phone FROM ({duck('customers')}) c"
SQL["phone_format"] = f"SELECT agent_id, agent_phone FROM ({duck('agents')}) c WHERE NOT {GOOD_PHONE.format(c='agent_phone')}"
SQL["range_check"] = f"""SELECT * FROM (SELECT _order, CASE WHEN rating_avg < 1 OR rating_avg > 5 THEN 'range_violation:rating_avg'
    WHEN on_time_rate < 0 OR on_time_rate > 1 THEN 'range_violation:on_time_rate'
    WHEN cancel_rate < 0 OR cancel_rate > 1 THEN 'range_violation:cancel_rate'
    WHEN completed_deliveries < 0 THEN 'range_violation:completed_deliveries' END AS label FROM ({coerced('drivers')}) c) x
  WHERE label IS NOT NULL"""
SQL["required_date"] = f"SELECT _order, 'invalid_date:order_created_at' AS label FROM ({coerced('orders')}) c WHERE order_created_at IS NULL"
SQL["constraint_check"] = f"""SELECT * FROM (SELECT _order, CASE WHEN order_id IS NULL THEN 'not_null:order_id'
    WHEN length(order_id) > 36 THEN 'too_long:order_id'
    WHEN order_amount * 500 >= 99999999.995 THEN 'does_not_fit:order_amount'
    WHEN order_status IS NULL THEN 'not_null:order_status' WHEN payment_method = 'cash' THEN 'too_long:payment_method'
    WHEN order_created_at IS NULL THEN 'not_null:order_created_at' END AS label FROM ({coerced('orders')}) c) x
  WHERE label IS NOT NULL"""
SQL["rejected_rows"] = f"SELECT _file, customer_id, reject AS rejection_reason FROM ({labelled('customers')}) l WHERE reject IS NOT NULL"
SQL["valid_rows"] = f"SELECT {as_text('customers')} FROM ({valid('customers')}) v"
SQL["validation_stats"] = f"""SELECT _file, CAST(sum(copies) AS BIGINT) AS total,
    CAST(sum(CASE WHEN keyed THEN copies - 1 ELSE copies END) AS BIGINT) AS duplicates_removed,
    count(CASE WHEN reject = 'null_violation' THEN 1 END) AS null_violations,
    count(CASE WHEN reject LIKE 'invalid_email:%' THEN 1 END) AS invalid_email,
    count(CASE WHEN reject LIKE 'invalid_phone:%' THEN 1 END) AS invalid_phone,
    count(CASE WHEN reject LIKE 'range%' THEN 1 END) AS range_violations,
    count(CASE WHEN reject LIKE 'invalid_date:%' THEN 1 END) AS date_violations, count(reject) AS total_rejected
  FROM ({labelled('customers')}) l GROUP BY 1"""

# References
SQL["fk_valid_orders"] = f"SELECT {as_text('orders')} FROM ({tested('orders')}) t WHERE orphan IS NULL"
SQL["fk_orphan_orders"] = f"""SELECT _file, order_id, orphan AS rejection_reason, replace(orphan, 'orphan_', '') || '_id' AS orphan_fk_col,
    coalesce(CAST(CAST(CASE orphan WHEN 'orphan_customer' THEN customer_id WHEN 'orphan_restaurant' THEN restaurant_id
      WHEN 'orphan_driver' THEN driver_id ELSE region_id END AS BIGINT) AS VARCHAR), '') AS orphan_fk_value
  FROM ({tested('orders')}) t WHERE orphan IS NOT NULL"""
SQL["fk_labels_by_value"] = SQL["fk_orphan_orders"]


def _declared_orphans() -> str:
    parts = []
    for name, spec in TABLES.items():
        cases, values = [], []
        for column, parent, label in declared_references(spec):
            keys = f"SELECT {KEYS[parent]} FROM ({coerced(parent)}) p WHERE CAST({KEYS[parent]} AS BIGINT) % 3 <> 1"
            bad = f"{column} NOT IN ({keys}) AND EXISTS ({keys})"
            cases.append(f"WHEN {bad} THEN '{label}'")
            values.append(f"WHEN {bad} THEN CAST(CAST({column} AS BIGINT) AS VARCHAR)")
        if cases:
            parts.append(f"""SELECT '{name}' AS child, rejection_reason, orphan_fk_value, count(*) AS rows FROM (
              SELECT CASE {' '.join(cases)} END AS rejection_reason, CASE {' '.join(values)} END AS orphan_fk_value
              FROM ({collapsed(name)}) c WHERE {spec.key} IS NOT NULL) x WHERE rejection_reason IS NOT NULL GROUP BY ALL""")
    return " UNION ALL ".join(parts)


SQL["fk_declared_all"] = _declared_orphans()
SQL["fk_cascade_label"] = f"SELECT _file, ticket_id, orphan AS label FROM ({tested('tickets')}) t"
for _query, _table in (("orphans_orders", "orders"), ("orphans_tickets", "tickets"), ("orphans_events", "ticket_events")):
    SQL[_query] = f"""SELECT orphan AS rejection_reason, count(*) AS rows FROM ({tested(_table)}) t
      WHERE orphan IS NOT NULL GROUP BY 1"""
SQL["dim_fk_check"] = f"""SELECT * FROM (SELECT customer_id,
    CASE WHEN region_id NOT IN (SELECT n_nationkey FROM nation) THEN 'unknown_region'
         WHEN segment_id = 4 THEN 'unknown_segment' END AS rejection_reason,
    CAST(CAST(CASE WHEN region_id NOT IN (SELECT n_nationkey FROM nation) THEN region_id ELSE segment_id END AS BIGINT) AS VARCHAR)
      AS orphan_fk_value
  FROM ({collapsed('customers')}) c WHERE customer_id IS NOT NULL) x WHERE rejection_reason IS NOT NULL"""
_RATE4 = "CASE WHEN {n} = 0 THEN 0.0 ELSE ((20000 * {s} + {n}) // (2 * {n})) / 10000.0 END"
SQL["orphan_stats"] = f"""SELECT _file, count(*) AS total, count(*) - count(orphan) AS valid, count(orphan) AS orphan_count,
    {_RATE4.format(s='count(orphan)', n='count(*)')} AS orphan_rate FROM ({tested('tickets')}) t GROUP BY 1"""
SQL["orphan_rate_alerts"] = f"""SELECT 'orders' AS table_name, _file AS source_file, count(orphan) AS orphan_count, count(*) AS total,
    {_RATE4.format(s='count(orphan)', n='count(*)')} AS orphan_rate,
    'Orphan rate ' || format('{{:.1f}}%', 100 * CAST(count(orphan) AS DOUBLE) / count(*)) ||
      ' exceeds threshold 8.0% for table ''orders''' AS message
  FROM ({tested('orders')}) t GROUP BY 2 HAVING CAST(count(orphan) AS DOUBLE) / count(*) > 0.08"""
SQL["late_dimension_orphans"] = """SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS order_id, 'orphan_customer' AS rejection_reason,
    CAST(o_custkey AS VARCHAR) AS orphan_fk_value FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""

# Audit
_STATS = f"""SELECT *, sl % 4 = 0 AS skipped FROM (
  SELECT _file, CAST(regexp_extract(_file, '/([0-9]+)/orders', 1) AS INT) AS sl, CAST(sum(copies) AS BIGINT) AS total,
    CAST(sum(CASE WHEN keyed THEN copies - 1 ELSE copies END) AS BIGINT) AS dups,
    count(CASE WHEN reject = 'null_violation' THEN 1 END) AS nulls, count(CASE WHEN reject LIKE 'range%' THEN 1 END) AS fmt,
    count(reject) AS rejected, count(CASE WHEN good THEN orphan END) AS orphans,
    count(CASE WHEN good AND orphan IS NULL THEN 1 END) AS loaded
  FROM (SELECT *, keyed AND reject IS NULL AS good, {ORDER_ORPHAN} AS orphan FROM ({labelled('orders')}) l) g GROUP BY 1) s"""
_LOG = f"""SELECT '{RUN_DATE}' AS run_date, '{RUN_TS}' AS run_timestamp, 'orders' AS table_name, _file AS source_file,
    total AS total_records, CASE WHEN skipped THEN total - rejected ELSE loaded END AS valid_records,
    CASE WHEN skipped THEN rejected ELSE rejected + orphans END AS rejected_records, dups AS duplicate_count,
    nulls AS null_violation_count, fmt AS invalid_format_count, orphans AS orphan_count,
    {_RATE4.format(s='orphans', n='(loaded + orphans)')} AS orphan_rate, CAST(340 AS BIGINT) AS processing_latency_ms,
    CASE WHEN skipped THEN 'skipped' ELSE 'success' END AS status FROM ({_STATS}) s"""
SQL["quality_log_rows"] = _LOG
SQL["quality_daily"] = _LOG
SQL["quality_overview"] = f"""SELECT table_name, total_records, valid_records, rejected_records, orphan_count,
    CAST(round(CAST(orphan_rate AS DECIMAL(6,4)) * 100, 2) AS DOUBLE) AS orphan_pct, processing_latency_ms, status FROM ({_LOG}) q"""
SQL["quality_latest"] = f"""SELECT table_name, total_records, valid_records, rejected_records, orphan_count, orphan_rate,
    processing_latency_ms, status FROM ({_LOG}) q ORDER BY total_records DESC, table_name, source_file LIMIT 20"""
SQL["file_success_rate"] = f"""SELECT count(*) AS total, count(CASE WHEN status = 'success' THEN 1 END) AS successful,
    ((20000 * count(CASE WHEN status = 'success' THEN 1 END) + count(*)) // (2 * count(*))) / 10000.0 AS success_rate FROM ({_LOG}) q"""
SQL["run_summary"] = f"""SELECT CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(rejected_records) AS BIGINT) AS rejected_records,
    CAST(sum(orphan_count) AS BIGINT) AS orphan_count, count(*) AS files_processed FROM ({_LOG}) q"""
SQL["batch_summary"] = f"""SELECT count(*) AS files_attempted, count(CASE WHEN NOT skipped THEN 1 END) AS files_succeeded,
    count(CASE WHEN skipped THEN 1 END) AS files_skipped,
    CAST(sum(CASE WHEN skipped THEN 0 ELSE loaded END) AS BIGINT) AS total_rows_loaded,
    CAST(sum(CASE WHEN skipped THEN 0 ELSE rejected + orphans END) AS BIGINT) AS total_rows_rejected FROM ({_STATS}) s"""
SQL["stream_summary"] = f"""WITH s AS ({_STATS}) SELECT slot, orders_loaded, CAST(0 AS BIGINT) AS tickets_loaded, CAST(0 AS BIGINT) AS events_loaded FROM (
    SELECT lpad(CAST(sl AS VARCHAR), 2, '0') AS slot, CAST(sum(loaded) AS BIGINT) AS orders_loaded FROM s WHERE NOT skipped GROUP BY 1
    UNION ALL SELECT 'all', CAST(sum(loaded) AS BIGINT) FROM s WHERE NOT skipped) x"""

# Merge
_TARGET = f"SELECT * FROM ({duck('fact_order')}) o WHERE order_created_at < TIMESTAMP '1999-01-01'"
_LOAD = """SELECT * FROM (SELECT 'ord-' || CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
    l_shipdate AS order_created_at, CAST(l_partkey AS INT) AS customer_id, CAST(l_suppkey AS INT) AS region_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
      l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) x WHERE rn = 1"""


def _merged(columns: tuple[str, ...]) -> str:
    def pick(c: str) -> str:
        chosen = f"CASE WHEN l.order_id IS NOT NULL THEN l.{c} ELSE t.{c} END" if c in columns else f"t.{c}"
        if c == "order_created_at":
            return f"strftime({chosen}, {TS}) AS {c}"
        return f"CAST({chosen} AS {'DOUBLE' if c == 'total_amount' else 'BIGINT'}) AS {c}"
    names = ", ".join(pick(c) for c in ("customer_id", "region_id", "total_amount", "order_created_at"))
    return f"""SELECT coalesce(l.order_id, t.order_id) AS order_id, {names}
      FROM ({_TARGET}) t FULL OUTER JOIN ({_LOAD}) l ON t.order_id = l.order_id"""


SQL["upsert_merge"] = _merged(("customer_id", "region_id", "total_amount", "order_created_at"))
SQL["upsert_partial_columns"] = _merged(("total_amount", "order_created_at"))
SQL["upsert_insert_only"] = _merged(())

# Ledger
_FILES = """SELECT 'stream/' || strftime(o_orderdate, '%Y-%m-%d') || '/08/orders.json' AS f, count(*) AS n,
    CAST(sum(o_orderkey) AS BIGINT) AS ks FROM orders GROUP BY 1"""
_LEDGER = f"""SELECT f AS file_path, CASE WHEN n % 4 = 0 THEN md5('old') ELSE md5(CAST(ks AS VARCHAR)) END AS md5_hash,
    '{RUN_TS}' AS processed_at, CASE WHEN ks % 5 = 0 THEN 'failed' WHEN ks % 5 = 1 THEN 'skipped' ELSE 'success' END AS status,
    n AS rows_loaded, ks % 7 AS rows_rejected FROM ({_FILES}) x WHERE n <> 5"""
SQL["ledger_pending"] = f"""SELECT f AS _file, md5(CAST(ks AS VARCHAR)) AS md5 FROM ({_FILES}) x
  WHERE NOT EXISTS (SELECT 1 FROM ({_LEDGER}) l WHERE l.file_path = f AND l.md5_hash = md5(CAST(ks AS VARCHAR)) AND status = 'success')"""
SQL["ledger_status"] = f"SELECT * FROM ({_LEDGER}) l WHERE file_path = 'stream/1996-03-06/08/orders.json'"
SQL["ledger_list"] = f"SELECT * FROM ({_LEDGER}) l WHERE file_path LIKE '%1996-03%'"
SQL["ledger_mark"] = f"""SELECT * FROM ({_LEDGER}) l WHERE file_path NOT IN (SELECT f FROM ({_FILES}) x WHERE n >= 5)
  UNION ALL SELECT f, md5(CAST(ks AS VARCHAR)), '2024-01-02 00:00:00.000000', 'success', n, 0 FROM ({_FILES}) x WHERE n >= 5"""

# Files
_SHORT = "created_at, updated_at"
SQL["csv_scan"] = f"""SELECT * EXCLUDE (_file, _order, line) REPLACE (
    CASE WHEN signup_date = 'N/A' THEN NULL ELSE signup_date END AS signup_date,
    CASE WHEN line % 7 = 3 THEN NULL ELSE created_at END AS created_at,
    CASE WHEN line % 7 = 3 THEN NULL ELSE updated_at END AS updated_at)
  FROM (SELECT *, {BAD_LINE} AS line FROM ({duck('customers')}) c WHERE customer_id IS NOT NULL) x
  WHERE line % 7 NOT IN (1, 2)"""
SQL["csv_encoding_fallback"] = """SELECT CAST(p_partkey AS VARCHAR) AS category_id, 'café ' || p_name AS category_name FROM part"""
SQL["csv_quoted_lines"] = """SELECT CAST(p_partkey AS VARCHAR) AS category_id,
    replace(p_name, ' ', chr(10)) || ', "' || p_type || '"' || chr(10) || chr(10) || ',' AS category_name FROM part"""
SQL["json_split_scan"] = """SELECT CAST(p_partkey AS VARCHAR) AS category_id, p_name || '}, {"' || chr(92) || p_type AS category_name FROM part"""
SQL["json_scan"] = f"SELECT {', '.join(as_text('orders').replace(f'strftime(order_created_at, {TS}) AS ', '').replace(f'strftime(delivered_at, {TS}) AS ', '').split(', '))} FROM ({duck('orders')}) o"
SQL["batch_manifest_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS rows FROM ({duck(t)}) x" for t in _BATCH_TABLES)
SQL["slot_scan"] = f"SELECT slot, count(*) AS rows, count(DISTINCT order_id) AS orders FROM ({duck('orders')}) o GROUP BY 1"
SQL["file_fingerprint"] = """SELECT p_type, block, md5(content) AS md5, octet_length(encode(content)) AS length FROM (
    SELECT p_type, p_partkey // 1000 AS block, string_agg(p_partkey || ',' || p_name || chr(10), '' ORDER BY p_partkey) AS content
    FROM part GROUP BY 1, 2) x"""
SQL["schema_required"] = f"""SELECT segment_id AS seg, CASE WHEN segment_id <= '2' THEN 'email, gender' ELSE '' END AS missing,
    CASE WHEN segment_id <= '2' THEN 0 ELSE count(*) END AS rows FROM ({duck('customers')}) c GROUP BY 1"""
SQL["schema_required_json"] = SQL["schema_required"]

# Jobs
_RINT = "CAST({c} AS BIGINT) AS {c}"


def _customers_job() -> str:
    """One day holds what the adapter spreads over three: a key is in one of them only."""
    ok = "region_id IS NULL OR region_id IN (SELECT n_nationkey FROM nation)"
    return f"""SELECT {_RINT.format(c='customer_id')}, full_name, sha256(email) AS email_hash,
        sha256({PHONE.format(c='phone')}) AS phone_hash, {_RINT.format(c='region_id')}, {_RINT.format(c='segment_id')},
        CAST(CAST(signup_date AS DATE) AS VARCHAR) AS signup_date, gender, strftime(created_at, {TS}) AS created_at,
        strftime(updated_at, {TS}) AS updated_at FROM ({valid('customers')}) v WHERE {ok}"""


SQL["batch_job_customers"] = _customers_job()


def _order_rows() -> str:
    return f"SELECT * FROM ({tested('orders')}) t WHERE orphan IS NULL"


def _last(rows: str, key: str) -> str:
    return f"""SELECT * EXCLUDE (last) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY slot DESC) AS last
      FROM ({rows}) r) x WHERE last = 1"""


def _money(*columns: str) -> str:
    return ", ".join(f"CAST(CAST({c} AS DECIMAL(12,2)) AS DOUBLE) AS {c}" for c in columns)


_IDS = ", ".join(_RINT.format(c=c) for c in ("customer_id", "restaurant_id", "driver_id", "region_id"))
SQL["stream_job_orders"] = f"""SELECT order_id, {_IDS},
    {_money('order_amount', 'delivery_fee', 'discount_amount', 'total_amount')}, order_status, payment_method,
    strftime(order_created_at, {TS}) AS order_created_at, strftime(delivered_at, {TS}) AS delivered_at
  FROM ({_last(_order_rows(), 'order_id')}) o"""
_FEW = f"""SELECT order_id, {_RINT.format(c='customer_id')}, order_status, {_money('total_amount')}
  FROM ({_last(_order_rows(), 'order_id')}) o"""
SQL["rerun_idempotent"] = _FEW
SQL["stream_watch_once"] = _FEW


def _ticket_rows() -> str:
    """A ticket needs an order loaded in its own slot or an earlier one."""
    return f"""SELECT t.* FROM ({valid('tickets')}) t
      JOIN (SELECT order_id AS oid, min(slot) AS since FROM ({_order_rows()}) o GROUP BY 1) k ON t.order_id = k.oid AND k.since <= t.slot
      WHERE agent_id IN (SELECT s_suppkey FROM supplier)"""


_T_IDS = ", ".join(_RINT.format(c=c) for c in (
    "customer_id", "driver_id", "restaurant_id", "agent_id", "reason_id", "priority_id", "channel_id"))
SQL["stream_job_tickets"] = f"""SELECT ticket_id, order_id, {_T_IDS}, status, {_money('refund_amount')},
    {as_text('tickets', list(DATES['tickets']))},
    CASE WHEN resolved_at IS NOT NULL THEN first_response_at > sla_first_due_at END AS is_first_response_breached,
    CASE WHEN resolved_at IS NOT NULL THEN resolved_at > sla_resolve_due_at END AS is_resolution_breached,
    CASE WHEN resolved_at IS NOT NULL THEN (2 * (epoch_us(first_response_at) - epoch_us(created_at)) + 1000000) // 2000000 END
      AS first_response_seconds,
    CASE WHEN resolved_at IS NOT NULL THEN ((epoch_us(resolved_at) - epoch_us(created_at)) * 2 + 600000) // 1200000 / 100.0 END
      AS resolution_minutes
  FROM ({_ticket_rows()}) t"""
SQL["stream_job_events"] = f"""SELECT event_id, ticket_id, {_RINT.format(c='agent_id')}, strftime(event_ts, {TS}) AS event_ts,
    old_status, new_status, notes FROM ({valid('ticket_events')}) e
  WHERE (ticket_id IN (SELECT ticket_id FROM ({_ticket_rows()}) t)
    OR slot < (SELECT min(slot) FROM ({_ticket_rows()}) t)) AND agent_id IN (SELECT s_suppkey FROM supplier)"""


# A whole day: the snapshot of thirteen tables, then its slots. Each table's rows r_ carry why they are not loaded, l_ are those that are.
_PARENTS = {
    "regions": ("city",), "reasons": ("reason_category",), "customers": ("region", "segment"), "restaurants": ("region", "category"),
    "drivers": ("region",), "agents": ("team",), "tickets": ("reason", "priority", "channel"),
}
_PLURAL = {"city": "cities", "category": "categories", "reason_category": "reason_categories", "priority": "priorities"}


def _unknown(name: str) -> str:
    """Keys that must exist if they are given."""
    cases = " ".join(f"WHEN {p}_id NOT IN (SELECT {p}_id FROM l_{_PLURAL.get(p, p + 's')}) THEN 'unknown_{p}'" for p in _PARENTS.get(name, ()))
    return f"CASE {cases} END" if cases else "CAST(NULL AS VARCHAR)"


_FACT_ORPHANS = {
    "orders": " ".join(f"WHEN {p}_id IS NULL OR {p}_id NOT IN (SELECT {p}_id FROM l_{p}s) THEN 'orphan_{p}'" for p in ("customer", "restaurant", "driver", "region")),
    "tickets": """WHEN slot >= (SELECT min(since) FROM k_orders) AND (since IS NULL OR since > slot) THEN 'orphan_order'
      WHEN agent_id NOT IN (SELECT agent_id FROM l_agents) THEN 'orphan_agent'""",
    "ticket_events": """WHEN slot >= (SELECT min(since) FROM k_tickets) AND (since IS NULL OR since > slot) THEN 'orphan_ticket'
      WHEN agent_id NOT IN (SELECT agent_id FROM l_agents) THEN 'orphan_agent'""",
}
_FACTS = {"orders": None, "tickets": "order", "ticket_events": "ticket"}


def _day() -> str:
    steps, counts = [], []
    for name in (*_BATCH_TABLES, *_FACTS):
        key, parent = KEYS[name], _FACTS.get(name)
        rows = labelled(name)
        if parent:
            rows = f"SELECT b.*, k.since FROM ({rows}) b LEFT JOIN k_{parent}s k ON k.{parent}_id = b.{parent}_id"
        orphan = f"CASE {_FACT_ORPHANS[name]} END" if name in _FACTS else "CAST(NULL AS VARCHAR)"
        slot = "slot" if name in _FACTS else "''"
        steps += [
            f"g_{name} AS (SELECT *, keyed AND reject IS NULL AS good, {orphan} AS misses FROM ({rows}) x)",
            f"""r_{name} AS (SELECT *, CASE WHEN good THEN misses END AS orphan, CASE WHEN good AND misses IS NULL THEN {_unknown(name)} END AS refused
              FROM g_{name})""",
            f"l_{name} AS (SELECT * FROM r_{name} WHERE good AND orphan IS NULL AND refused IS NULL)"]
        if name in _FACTS:
            steps.append(f"k_{name} AS (SELECT {key}, min(slot) AS since FROM l_{name} GROUP BY 1)")
        counts.append(f"""SELECT '{name}' AS table_name, {slot} AS slot, CAST(sum(copies) AS BIGINT) AS total,
            CAST(sum(CASE WHEN keyed THEN copies - 1 ELSE copies END) AS BIGINT) AS dups, count(CASE WHEN reject = 'null_violation' THEN 1 END) AS nulls,
            count(CASE WHEN reject <> 'null_violation' THEN 1 END) AS fmt, count(reject) AS rejected, count(orphan) AS orphans, count(refused) AS refused,
            count(CASE WHEN good AND orphan IS NULL AND refused IS NULL THEN 1 END) AS loaded FROM r_{name} GROUP BY ALL""")
    return "WITH " + ",\n".join([*steps, "s AS (SELECT *, CASE WHEN loaded > 0 THEN 'success' ELSE 'skipped' END AS status FROM (" + " UNION ALL ".join(counts) + ") c)"])


_DAY = _day()
_LOST = "CASE WHEN loaded > 0 THEN rejected + orphans + refused WHEN orphans + refused > 0 THEN orphans + refused ELSE rejected END"
SQL["job_quality_log"] = f"""{_DAY} SELECT table_name, slot, status, total AS total_records,
    CASE WHEN loaded > 0 THEN loaded ELSE total - rejected END AS valid_records,
    CASE WHEN loaded > 0 THEN rejected + orphans + refused ELSE rejected END AS rejected_records, dups AS duplicate_count,
    nulls AS null_violation_count, fmt AS invalid_format_count, orphans AS orphan_count FROM s"""
SQL["job_ledger"] = f"{_DAY} SELECT table_name, slot, status, loaded AS rows_loaded, {_LOST} AS rows_rejected FROM s"
SQL["job_quarantine"] = _DAY + " SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, CASE WHEN reject IS NOT NULL THEN 'data_validation' WHEN orphan IS NOT NULL THEN 'orphan_reference'
      ELSE 'warehouse_constraint' END AS reason, coalesce(reject, orphan, refused) AS rejection_detail,
      CASE WHEN orphan IS NOT NULL THEN replace(orphan, 'orphan_', '') || '_id' END AS orphan_fk_col, count(*) AS rows
      FROM r_{t} WHERE coalesce(reject, orphan, refused) IS NOT NULL GROUP BY ALL""" for t in (*_BATCH_TABLES, *_FACTS)) + ") q"
SQL["job_alerts"] = f"""{_DAY} SELECT 'orphan_rate' AS kind, table_name, slot, orphans AS affected_rows, loaded + orphans + refused AS total_rows
  FROM s WHERE orphans > 0.05 * (loaded + orphans + refused)"""
SQL["job_star_counts"] = _DAY + " " + " UNION ALL ".join(
    f"SELECT '{'fact_' if t in _FACTS else 'dim_'}{KEYS[t].removesuffix('_id') if t != 'ticket_events' else 'ticket_event'}' AS tbl, count(DISTINCT {KEYS[t]}) AS rows FROM l_{t}"
    for t in (*_BATCH_TABLES, *_FACTS))
SQL["job_key_index"] = SQL["job_star_counts"]
SQL["job_summaries"] = f"""{_DAY}, f AS (SELECT slot, CAST(sum(CASE WHEN table_name = 'orders' THEN loaded ELSE 0 END) AS BIGINT) AS orders_loaded,
    CAST(sum(CASE WHEN table_name = 'tickets' THEN loaded ELSE 0 END) AS BIGINT) AS tickets_loaded,
    CAST(sum(CASE WHEN table_name = 'ticket_events' THEN loaded ELSE 0 END) AS BIGINT) AS events_loaded FROM s WHERE slot <> '' AND loaded > 0 GROUP BY 1)
  SELECT *, CAST(NULL AS BIGINT) AS total_rows_loaded, CAST(NULL AS BIGINT) AS total_rows_rejected FROM f
  UNION ALL SELECT 'all', CAST(sum(orders_loaded) AS BIGINT), CAST(sum(tickets_loaded) AS BIGINT), CAST(sum(events_loaded) AS BIGINT), NULL, NULL FROM f
  UNION ALL SELECT 'snapshot', NULL, NULL, NULL, CAST(sum(loaded) AS BIGINT), CAST(sum(rejected + orphans + refused) AS BIGINT) FROM s WHERE slot = '' AND loaded > 0"""

# Views kept as states by day
SQL["state_sla_daily"] = SLA_DAILY
SQL["state_sla_by_restaurant"] = BY_RESTAURANT
SQL["state_sla_by_driver"] = BY_DRIVER
SQL["state_sla_summary_day"] = SQL["sla_summary_day"]
SQL["state_sla_health_7"] = SQL["sla_health_7"]
