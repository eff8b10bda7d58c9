"""The six service-level views.

Each aggregates the ticket side down to its join key before it meets another
table, so a key with a third of all tickets reaches a join as one row. Tables
are unique by their keys, as the merge leaves them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergate.functions.rounding import cents, percent, ratio

DAY = F.to_date


def _flag_count(flag: str) -> Column:
    return F.sum(F.col(flag).cast("int"))


def _mean_cents(total: Column, count: Column) -> Column:
    """Mean of amounts with two digits, again to two digits."""
    return ratio(cents(total), count, digits=0) / F.lit(100.0)


def daily_sums(tickets: DataFrame) -> DataFrame:
    """Counts and sums of tickets with a known first-response flag, by day."""
    first, resolve = "is_first_response_breached", "is_resolution_breached"
    return tickets.where(F.col(first).isNotNull()).groupBy(DAY("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("total_tickets"),
        _flag_count(first).alias("fr_breaches"),
        _flag_count(resolve).alias("res_breaches"),
        F.count(resolve).alias("_res_known"),
        F.sum("first_response_seconds").alias("_sec"),
        F.count("first_response_seconds").alias("_sec_n"),
        F.sum("resolution_minutes").alias("_min"),
        F.count("resolution_minutes").alias("_min_n"),
        F.sum("refund_amount").alias("total_refunds"),
        F.count_distinct("agent_id").alias("agents_involved"),
    )


def daily_view(sums: DataFrame, ordered: bool = True) -> DataFrame:
    view = sums.select(
        "day",
        "total_tickets",
        "fr_breaches",
        percent(F.col("fr_breaches"), F.col("total_tickets")).alias("fr_breach_rate_pct"),
        "res_breaches",
        percent(F.col("res_breaches"), F.col("_res_known")).alias("res_breach_rate_pct"),
        ratio(F.col("_sec"), F.col("_sec_n"), digits=1).alias("avg_first_response_sec"),
        _mean_cents(F.col("_min"), F.col("_min_n")).alias("avg_resolution_min"),
        "total_refunds",
        "agents_involved",
    )
    return view.orderBy(F.desc_nulls_first("day")) if ordered else view


def sla_daily(tickets: DataFrame, ordered: bool = True) -> DataFrame:
    return daily_view(daily_sums(tickets), ordered)


def key_sums(tickets: DataFrame, *keys: str) -> DataFrame:
    """Tickets with a known resolution flag, summed per ``keys``."""
    return tickets.where(F.col("is_resolution_breached").isNotNull()).groupBy(*keys).agg(
        F.count("ticket_id").alias("total_tickets"),
        _flag_count("is_resolution_breached").alias("_late"),
        F.count("is_resolution_breached").alias("_late_n"),
        _flag_count("is_first_response_breached").alias("_slow"),
        F.count("is_first_response_breached").alias("_slow_n"),
        F.sum("resolution_minutes").alias("_min"),
        F.count("resolution_minutes").alias("_min_n"),
        F.sum("refund_amount").alias("total_refunds"),
    )


def sla_by_restaurant(
    tickets: DataFrame, restaurants: DataFrame, categories: DataFrame, regions: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    return restaurant_view(key_sums(tickets, "restaurant_id"), restaurants, categories, regions, ordered)


def restaurant_view(
    sums: DataFrame, restaurants: DataFrame, categories: DataFrame, regions: DataFrame, ordered: bool = True,
) -> DataFrame:
    places = (
        restaurants.select("restaurant_id", "restaurant_name", "category_id", "region_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .join(regions.select("region_id", "region_name"), "region_id")
    )
    view = sums.join(places, "restaurant_id").select(
        "restaurant_id", "restaurant_name", "category_name", "region_name", "total_tickets",
        percent(F.col("_late"), F.col("_late_n")).alias("res_breach_rate_pct"),
        _mean_cents(F.col("_min"), F.col("_min_n")).alias("avg_resolution_min"),
        "total_refunds",
    )
    order = F.desc_nulls_first("res_breach_rate_pct"), F.asc("restaurant_id")
    return view.orderBy(*order) if ordered else view


def sla_by_driver(tickets: DataFrame, drivers: DataFrame, ordered: bool = True) -> DataFrame:
    return driver_view(key_sums(tickets, "driver_id"), drivers, ordered)


def driver_view(sums: DataFrame, drivers: DataFrame, ordered: bool = True) -> DataFrame:
    people = drivers.select("driver_id", "driver_name", "vehicle_type", "on_time_rate", "cancel_rate")
    view = sums.join(people, "driver_id").select(
        "driver_id", "driver_name", "vehicle_type", "total_tickets",
        percent(F.col("_late"), F.col("_late_n")).alias("res_breach_rate_pct"),
        "total_refunds", "on_time_rate", "cancel_rate",
    )
    order = F.desc_nulls_first("total_tickets"), F.asc("driver_id")
    return view.orderBy(*order) if ordered else view


def sla_by_region(
    tickets: DataFrame, orders: DataFrame, regions: DataFrame, cities: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """By the region of the order. Regions are summed by id first, then by name."""
    sums = ["total_tickets", "_late", "_late_n", "_slow", "_slow_n", "total_refunds"]
    total = [F.sum(c).alias(c) for c in sums]
    per_region = (
        key_sums(tickets, "order_id")
        .join(orders.select("order_id", "region_id"), "order_id")
        .groupBy("region_id").agg(*total)
    )
    named = (
        per_region.join(regions.select("region_id", "region_name", "city_id"), "region_id")
        .join(cities.select("city_id", "city_name"), "city_id")
        .groupBy("city_name", "region_name").agg(*total)
    )
    view = named.select(
        "city_name", "region_name", "total_tickets",
        percent(F.col("_slow"), F.col("_slow_n")).alias("fr_breach_rate_pct"),
        percent(F.col("_late"), F.col("_late_n")).alias("res_breach_rate_pct"),
        "total_refunds",
    )
    order = F.desc_nulls_first("res_breach_rate_pct"), F.asc("city_name"), F.asc("region_name")
    return view.orderBy(*order) if ordered else view


def revenue_impact(tickets: DataFrame, orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Per ticket day. An order with several tickets counts once per ticket."""
    per_order = tickets.groupBy(DAY("created_at").alias("day"), "order_id").agg(
        F.count("ticket_id").alias("_tickets"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("refund_amount").alias("_refunds"),
    )
    sums = (
        per_order.join(orders.select("order_id", "total_amount"), "order_id")
        .groupBy("day").agg(
            F.sum("_tickets").alias("total_tickets"),
            F.sum("_refunds").alias("total_refunds"),
            F.sum("_rows").alias("total_orders"),
            F.sum(F.col("total_amount") * F.col("_rows")).cast("decimal(30,2)").alias("total_revenue"),
        )
    )
    view = sums.select(
        "*",
        ratio(cents(F.col("total_refunds")), cents(F.col("total_revenue")), digits=2, scale=100)
        .alias("refund_pct_of_revenue"),
        ratio(F.col("total_tickets"), F.col("total_orders"), digits=2, scale=1000)
        .alias("complaint_rate_per_1000_orders"),
    )
    return view.orderBy(F.desc_nulls_first("day")) if ordered else view


def reopen_rate(tickets: DataFrame, events: DataFrame, ordered: bool = True) -> DataFrame:
    """Reopened tickets are reduced to distinct ids before they meet the tickets."""
    reopened = (
        events.where(F.col("new_status") == "Reopened")
        .select(F.col("ticket_id"), F.lit(True).alias("_reopened")).distinct()
    )
    sums = (
        tickets.select("ticket_id", DAY("created_at").alias("day"))
        .join(reopened, "ticket_id", "left")
        .groupBy("day").agg(
            F.count("ticket_id").alias("total_tickets"),
            F.count("_reopened").alias("reopened_tickets"),
        )
    )
    view = sums.select(
        "*", percent(F.col("reopened_tickets"), F.col("total_tickets")).alias("reopen_rate_pct"))
    return view.orderBy(F.desc_nulls_first("day")) if ordered else view
