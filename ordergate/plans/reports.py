"""Report queries over the views and tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergate.plans import views


def sla_summary(tickets: DataFrame, day: str) -> DataFrame:
    """One day's row of the daily view. The filter reaches the scan as a time range."""
    start = F.lit(day).cast("date")
    in_day = (
        (F.col("created_at") >= start.cast("timestamp_ntz"))
        & (F.col("created_at") < F.date_add(start, 1).cast("timestamp_ntz"))
    )
    return views.sla_daily(tickets.where(in_day), ordered=False)


def sla_health(tickets: DataFrame, days: int = 7) -> DataFrame:
    return views.sla_daily(tickets, ordered=False).orderBy(F.desc_nulls_first("day")).limit(days)


def top_refund_restaurants(by_restaurant: DataFrame, rows: int = 10) -> DataFrame:
    return by_restaurant.orderBy(F.desc_nulls_first("total_refunds"), "restaurant_id").limit(rows).select(
        "restaurant_name", "total_refunds", "res_breach_rate_pct")


def worst_drivers(by_driver: DataFrame, min_tickets: int = 5, rows: int = 10) -> DataFrame:
    return (
        by_driver.where(F.col("total_tickets") >= min_tickets)
        .orderBy(F.desc_nulls_first("res_breach_rate_pct"), "driver_id").limit(rows)
        .select("driver_name", "vehicle_type", "total_tickets", "res_breach_rate_pct")
    )


def late_restaurants(by_restaurant: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of the restaurant view in its own order."""
    return by_restaurant.orderBy(F.desc_nulls_first("res_breach_rate_pct"), "restaurant_id").limit(rows)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
