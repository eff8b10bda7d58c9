"""Views kept as partial sums by day of the ticket table.

A state holds, for each part (day) of the tickets, the sums its view needs: exact, and
mergeable by adding up. Agents are counted per day, which no other day shares. Every state remembers from which
folders a day was summed, so a refresh reads only days whose folders have changed: those with new, late or
corrected tickets. The views of states equal the views of all tickets.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.plans import views
from ordergate.registry import table
from ordergate.warehouse import Transaction, Warehouse

_TICKETS = table("tickets")


def _daily(tickets: DataFrame) -> DataFrame:
    return views.daily_sums(tickets).withColumn("part", F.coalesce(F.col("day").cast("string"), F.lit("none")))


_STATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "state_daily": _daily,
    "state_by_restaurant": lambda tickets: views.key_sums(tickets, "part", "restaurant_id"),
    "state_by_driver": lambda tickets: views.key_sums(tickets, "part", "driver_id"),
}


def refresh(warehouse: Warehouse) -> list[str]:
    """Bring the states up to date; returns the days that were read. Tried again if the tickets change meanwhile."""
    return warehouse.transact(_refresh)


def _refresh(writes: Transaction) -> list[str]:
    name = _TICKETS.warehouse_name
    writes.depends.update({name, *_STATES})
    folders = writes._state().folders(name)
    now = {day: f"{len(f)}-{crc32(' '.join(f).encode())}" for day, f in folders.items()}
    read: set[str] = set()
    for state, sums in _STATES.items():
        summed = writes._state().facts.get(state, {}).get("days", {})
        stale = {day for day in now.keys() | summed.keys() if now.get(day) != summed.get(day)}
        if stale:
            tickets = writes._read(name, _TICKETS.warehouse_schema, {day: folders[day] for day in stale if day in folders})
            writes.replace_parts(state, sums(tickets), stale, {"days": now})
            read |= stale & now.keys()
    return sorted(read)


def _state(warehouse: Warehouse, name: str, days: Callable[[list[str]], list[str]] = list) -> DataFrame:
    folders = warehouse._state().folders(name)
    nothing = warehouse._read(_TICKETS.warehouse_name, _TICKETS.warehouse_schema, {})
    schema = T.StructType([f for f in _STATES[name](nothing).schema if f.name != "part"])
    wanted = days(sorted(folders))
    return warehouse._read(name, schema, {d: folders[d] for d in wanted}).drop("part")


def _added(sums: DataFrame, key: str) -> DataFrame:
    """The days of one key added up, in the types they have."""
    return sums.groupBy(key).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in sums.schema if f.name != key])


def sla_daily(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    return views.daily_view(_state(warehouse, "state_daily"), ordered)


def sla_summary(warehouse: Warehouse, day: str) -> DataFrame:
    """One day's row; only its part is opened."""
    return views.daily_view(_state(warehouse, "state_daily", lambda days: [d for d in days if d == day]), ordered=False)


def sla_health(warehouse: Warehouse, days: int = 7) -> DataFrame:
    """The last days that have a row in the daily view; only their parts are opened, whatever the length of the history."""
    return views.daily_view(_state(warehouse, "state_daily", lambda found: found[-days:]))


def sla_by_restaurant(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    sums = _added(_state(warehouse, "state_by_restaurant"), "restaurant_id")
    return views.restaurant_view(sums, *(warehouse.read(t) for t in ("restaurants", "categories", "regions")), ordered)


def sla_by_driver(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    sums = _added(_state(warehouse, "state_by_driver"), "driver_id")
    return views.driver_view(sums, warehouse.read("drivers"), ordered)
