"""Table registry: the columns, rules and warehouse types of every input table.

One :class:`TableSpec` answers all questions the operators ask about a table.
Row rules are kept as ordered tuples because the *first* failing rule labels a
rejected row, so their order is part of the result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, NUMBER, DATE = "text", "number", "date"


@dataclass(frozen=True)
class Column:
    """A source column: how its text is coerced and what the warehouse stores."""

    name: str
    coerce: str
    stored: T.DataType
    max_length: int | None = None
    required: bool = False
    hashed_as: str | None = None
    references: str | None = None
    not_null_stored: bool = False

    @property
    def stored_name(self) -> str:
        return self.hashed_as or self.name


@dataclass(frozen=True)
class TableSpec:
    name: str
    warehouse_name: str
    key: str
    columns: tuple[Column, ...]
    email: tuple[str, ...] = ()
    phone: tuple[str, ...] = ()
    ranges: tuple[tuple[str, float | None, float | None], ...] = ()
    checks: tuple[tuple[str, float | None, float | None], ...] = ()
    required_dates: tuple[str, ...] = ()
    derived: tuple[T.StructField, ...] = ()
    partition_by: str | None = None
    by_name: dict[str, Column] = field(default_factory=dict, compare=False)

    def __post_init__(self) -> None:
        self.by_name.update({c.name: c for c in self.columns})

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def pii(self) -> list[Column]:
        return [c for c in self.columns if c.hashed_as]

    @property
    def warehouse_schema(self) -> T.StructType:
        stored = [T.StructField(c.stored_name, c.stored) for c in self.columns]
        return T.StructType(stored + list(self.derived))


def _int(name: str, required: bool = False, references: str | None = None) -> Column:
    return Column(name, NUMBER, T.IntegerType(), required=required, references=references)


def _dec(name: str, precision: int, scale: int) -> Column:
    return Column(name, NUMBER, T.DecimalType(precision, scale))


def _str(name: str, length: int | None, required: bool = False, **more) -> Column:
    return Column(name, TEXT, T.StringType(), max_length=length, required=required, **more)


def _bool(name: str) -> Column:
    return Column(name, TEXT, T.BooleanType())


def _date(name: str) -> Column:
    return Column(name, DATE, T.DateType())


def _ts(name: str, required: bool = False) -> Column:
    return Column(name, DATE, T.TimestampNTZType(), required=required)


def _pii(name: str, hashed_as: str) -> Column:
    return Column(name, TEXT, T.StringType(), hashed_as=hashed_as)


_STAMPS = (_ts("created_at"), _ts("updated_at"))

# Table and column names, types, bounds and rule order that
# results depend on.
_SPECS = (
    TableSpec("cities", "dim_city", "city_id", (
        _int("city_id", True), _str("city_name", 100, True),
        _str("country", 100), _str("timezone", 50))),
    TableSpec("regions", "dim_region", "region_id", (
        _int("region_id", True), _str("region_name", 100, True),
        _int("city_id", True, references="cities"), _dec("delivery_base_fee", 8, 2)),
        ranges=(("delivery_base_fee", 0, None),)),
    TableSpec("segments", "dim_segment", "segment_id", (
        _int("segment_id", True), _str("segment_name", 50, True),
        _int("discount_pct"), _bool("priority_support"))),
    TableSpec("categories", "dim_category", "category_id", (
        _int("category_id", True), _str("category_name", 100, True))),
    TableSpec("teams", "dim_team", "team_id", (
        _int("team_id", True), _str("team_name", 100, True))),
    TableSpec("reason_categories", "dim_reason_category", "reason_category_id", (
        _int("reason_category_id", True), _str("category_name", 100, True))),
    TableSpec("reasons", "dim_reason", "reason_id", (
        _int("reason_id", True), _str("reason_name", 200, True),
        _int("reason_category_id", True, references="reason_categories"),
        _int("severity_level"), _dec("typical_refund_pct", 5, 3)),
        ranges=(("severity_level", 1, 5), ("typical_refund_pct", 0, 1)),
        checks=(("severity_level", 1, 5), ("typical_refund_pct", 0, 1))),
    TableSpec("channels", "dim_channel", "channel_id", (
        _int("channel_id", True), _str("channel_name", 50, True))),
    TableSpec("priorities", "dim_priority", "priority_id", (
        _int("priority_id", True), _str("priority_code", 10, not_null_stored=True),
        _str("priority_name", 50, True),
        _int("sla_first_response_min"), _int("sla_resolution_min"))),
    TableSpec("customers", "dim_customer", "customer_id", (
        _int("customer_id", True), _str("full_name", 200),
        _pii("email", "email_hash"), _pii("phone", "phone_hash"),
        _int("region_id", references="regions"), _int("segment_id", references="segments"),
        _date("signup_date"), _str("gender", 10), *_STAMPS),
        email=("email",), phone=("phone",)),
    TableSpec("restaurants", "dim_restaurant", "restaurant_id", (
        _int("restaurant_id", True), _str("restaurant_name", 200),
        _int("region_id", references="regions"), _int("category_id", references="categories"),
        _str("price_tier", 10), _dec("rating_avg", 3, 2), _int("prep_time_avg_min"),
        _bool("is_active"), *_STAMPS),
        ranges=(("rating_avg", 1, 5), ("prep_time_avg_min", 1, None))),
    TableSpec("drivers", "dim_driver", "driver_id", (
        _int("driver_id", True), _str("driver_name", 200),
        _pii("driver_phone", "phone_hash"), _pii("national_id", "national_id_hash"),
        _int("region_id", references="regions"), _str("shift", 20), _str("vehicle_type", 20),
        _date("hire_date"), _dec("rating_avg", 3, 2), _dec("on_time_rate", 5, 3),
        _dec("cancel_rate", 5, 3), _int("completed_deliveries"), _bool("is_active"), *_STAMPS),
        phone=("driver_phone",),
        ranges=(("rating_avg", 1, 5), ("on_time_rate", 0, 1), ("cancel_rate", 0, 1),
                ("completed_deliveries", 0, None))),
    TableSpec("agents", "dim_agent", "agent_id", (
        _int("agent_id", True), _str("agent_name", 200, True),
        _pii("agent_email", "email_hash"), _pii("agent_phone", "phone_hash"),
        _int("team_id", references="teams"), _str("skill_level", 20), _date("hire_date"),
        _int("avg_handle_time_min"), _dec("resolution_rate", 5, 3), _dec("csat_score", 4, 2),
        _bool("is_active"), *_STAMPS),
        email=("agent_email",), phone=("agent_phone",),
        ranges=(("resolution_rate", 0, 1), ("csat_score", 1, 5),
                ("avg_handle_time_min", 1, None))),
    TableSpec("orders", "fact_order", "order_id", (
        _str("order_id", 36, True),
        _int("customer_id", True, references="customers"),
        _int("restaurant_id", True, references="restaurants"),
        _int("driver_id", True, references="drivers"),
        _int("region_id", references="regions"),
        _dec("order_amount", 10, 2), _dec("delivery_fee", 8, 2), _dec("discount_amount", 8, 2),
        _dec("total_amount", 10, 2), _str("order_status", 20, True), _str("payment_method", 20),
        _ts("order_created_at", True), _ts("delivered_at")),
        ranges=(("order_amount", 0, None), ("delivery_fee", 0, None),
                ("discount_amount", 0, None), ("total_amount", 0, None)),
        required_dates=("order_created_at",), partition_by="order_created_at"),
    TableSpec("tickets", "fact_ticket", "ticket_id", (
        _str("ticket_id", 36, True), _str("order_id", 36, True, references="orders"),
        _int("customer_id"), _int("driver_id"), _int("restaurant_id"),
        _int("agent_id", True, references="agents"),
        _int("reason_id", references="reasons"), _int("priority_id", references="priorities"),
        _int("channel_id", references="channels"), _str("status", 20, True),
        _dec("refund_amount", 10, 2), _ts("created_at", True), _ts("first_response_at"),
        _ts("resolved_at"), _ts("sla_first_due_at"), _ts("sla_resolve_due_at")),
        ranges=(("refund_amount", 0, None),),
        required_dates=("created_at",), partition_by="created_at",
        derived=(
            T.StructField("is_first_response_breached", T.BooleanType()),
            T.StructField("is_resolution_breached", T.BooleanType()),
            T.StructField("first_response_seconds", T.IntegerType()),
            T.StructField("resolution_minutes", T.DecimalType(8, 2)))),
    TableSpec("ticket_events", "fact_ticket_event", "event_id", (
        _str("event_id", 36, True), _str("ticket_id", 36, True, references="tickets"),
        _int("agent_id", True, references="agents"), _ts("event_ts", True),
        _str("old_status", 20), _str("new_status", 20, True), _str("notes", None)),
        required_dates=("event_ts",), partition_by="event_ts"),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
_BY_WAREHOUSE_NAME = {spec.warehouse_name: spec for spec in _SPECS}

# Daily snapshot files, lookups before the entities that refer to them.
BATCH_FILES: tuple[tuple[str, str, str], ...] = (
    ("cities", "cities.json", "json"),
    ("regions", "regions.csv", "csv"),
    ("segments", "segments.csv", "csv"),
    ("categories", "categories.csv", "csv"),
    ("teams", "teams.csv", "csv"),
    ("reason_categories", "reason_categories.csv", "csv"),
    ("reasons", "reasons.csv", "csv"),
    ("channels", "channels.csv", "csv"),
    ("priorities", "priorities.csv", "csv"),
    ("customers", "customers.csv", "csv"),
    ("restaurants", "restaurants.json", "json"),
    ("drivers", "drivers.csv", "csv"),
    ("agents", "agents.csv", "csv"),
)

# Hourly fact files, parents before children.
STREAM_FILES: tuple[tuple[str, str, str], ...] = (
    ("orders", "orders.json", "json"),
    ("tickets", "tickets.csv", "csv"),
    ("ticket_events", "ticket_events.json", "json"),
)

# Foreign keys whose violation quarantines a fact row: (column, parent, label).
FACT_REFERENCES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "orders": (
        ("customer_id", "customers", "orphan_customer"),
        ("restaurant_id", "restaurants", "orphan_restaurant"),
        ("driver_id", "drivers", "orphan_driver"),
        ("region_id", "regions", "orphan_region"),
    ),
    "tickets": (
        ("order_id", "orders", "orphan_order"),
        ("agent_id", "agents", "orphan_agent"),
    ),
    "ticket_events": (
        ("ticket_id", "tickets", "orphan_ticket"),
        ("agent_id", "agents", "orphan_agent"),
    ),
}

QUALITY_LOG_SCHEMA = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("run_timestamp", T.TimestampNTZType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("valid_records", T.LongType()),
    T.StructField("rejected_records", T.LongType()),
    T.StructField("duplicate_count", T.LongType()),
    T.StructField("null_violation_count", T.LongType()),
    T.StructField("invalid_format_count", T.LongType()),
    T.StructField("orphan_count", T.LongType()),
    T.StructField("orphan_rate", T.DecimalType(6, 4)),
    T.StructField("processing_latency_ms", T.LongType()),
    T.StructField("status", T.StringType()),
])

# What needs someone's attention after a run.
ALERT_SCHEMA = T.StructType([
    T.StructField("run_date", T.DateType()),
    T.StructField("run_timestamp", T.TimestampNTZType()),
    T.StructField("kind", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("affected_rows", T.LongType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("message", T.StringType()),
])


def table(name: str) -> TableSpec:
    """Look a table up by source or warehouse name; unknown names are an error."""
    spec = TABLES.get(name) or _BY_WAREHOUSE_NAME.get(name)
    if spec is None:
        raise ValueError(f"unknown table {name!r}; known: {sorted(TABLES)}")
    return spec


def declared_references(spec: TableSpec) -> tuple[tuple[str, str, str], ...]:
    """Foreign keys the warehouse declares but the fact cascade does not test.

    Unlike the cascade these let NULL pass, as an SQL foreign key does.
    """
    cascaded = {column for column, _, _ in FACT_REFERENCES.get(spec.name, ())}
    return tuple(
        (c.name, c.references, f"unknown_{c.name.removesuffix('_id')}")
        for c in spec.columns
        if c.references and c.name not in cascaded
    )
