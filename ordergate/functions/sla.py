"""Service-level columns of a ticket."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default service levels in minutes.
FIRST_RESPONSE_MINUTES = 1
RESOLUTION_MINUTES = 15


def plus_minutes(col: Column, minutes: Column) -> Column:
    zero = F.lit(0)
    return col + F.make_dt_interval(zero, zero, minutes.cast("int"), zero.cast("decimal(18,6)"))


def with_due_times(
    tickets: DataFrame,
    priorities: DataFrame | None = None,
    first_response_minutes: int = FIRST_RESPONSE_MINUTES,
    resolution_minutes: int = RESOLUTION_MINUTES,
) -> DataFrame:
    """Fill missing due times from the priority's own minutes, else the defaults."""
    first, resolve = F.lit(first_response_minutes), F.lit(resolution_minutes)
    df = tickets
    if priorities is not None:
        minutes = priorities.select(
            "priority_id",
            F.col("sla_first_response_min").alias("_first_min"),
            F.col("sla_resolution_min").alias("_resolve_min"),
        )
        df = df.join(minutes, "priority_id", "left")
        first, resolve = F.coalesce("_first_min", first), F.coalesce("_resolve_min", resolve)
    due = {
        "sla_first_due_at": plus_minutes(F.col("created_at"), first),
        "sla_resolve_due_at": plus_minutes(F.col("created_at"), resolve),
    }
    filled = {
        name: F.coalesce(F.col(name), value) if name in tickets.columns else value
        for name, value in due.items()
    }
    return df.withColumns(filled).drop("_first_min", "_resolve_min")


def _micros_between(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))


def _half_up(micros: Column, unit: int) -> Column:
    """Whole units of ``unit`` microseconds, rounded half away from zero."""
    steps = F.call_function("div", F.abs(micros) * 2 + F.lit(unit), F.lit(2 * unit))
    return F.when(micros < 0, -steps).otherwise(steps)


def flag_columns() -> Mapping[str, Column]:
    """The four derived columns, each NULL unless all four timestamps are known."""
    known = (
        F.col("first_response_at").isNotNull()
        & F.col("resolved_at").isNotNull()
        & F.col("sla_first_due_at").isNotNull()
        & F.col("sla_resolve_due_at").isNotNull()
    )
    seconds = _half_up(_micros_between("created_at", "first_response_at"), 1_000_000)
    hundredths = _half_up(_micros_between("created_at", "resolved_at"), 600_000)
    return {
        "is_first_response_breached": F.when(
            known, F.col("first_response_at") > F.col("sla_first_due_at")),
        "is_resolution_breached": F.when(
            known, F.col("resolved_at") > F.col("sla_resolve_due_at")),
        "first_response_seconds": F.when(known, seconds.try_cast("int")),
        "resolution_minutes": F.when(
            known, (hundredths.cast("decimal(20,0)") / 100).try_cast("decimal(8,2)")),
    }


def needs_refresh() -> Column:
    """Rows an incremental refresh would change."""
    return (
        F.col("is_first_response_breached").isNull()
        & flag_columns()["is_first_response_breached"].isNotNull()
    )


def with_sla_flags(tickets: DataFrame, incremental: bool = False) -> DataFrame:
    """Derive the flags; ``incremental`` leaves rows alone that already have them."""
    fresh = flag_columns()
    if not incremental:
        return tickets.withColumns(dict(fresh))
    due = needs_refresh()
    return tickets.withColumns(
        {name: F.when(due, value).otherwise(F.col(name)) for name, value in fresh.items()}
    )
