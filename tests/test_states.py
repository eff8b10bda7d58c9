"""Views from states equal views from rows, and only changed days are read."""

from pyspark.sql import functions as F

from ordergate.functions.sla import with_sla_flags
from ordergate.plans import states, views
from ordergate.warehouse import Warehouse


def tickets(spark, ids, shift=0):
    """Tickets of 20 days; some without an answer, and none answered on day 7."""
    day = (F.col("id") % 20 + 1).cast("int")
    at = F.make_timestamp_ntz(F.lit(2026), F.lit(3), day, F.lit(9), F.lit(0), F.lit(0))
    after = lambda s: at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))
    rows = spark.createDataFrame([(i,) for i in ids], "id long").select(
        F.concat(F.lit("t"), "id").alias("ticket_id"), F.lit("o").alias("order_id"), (F.col("id") % 3).cast("int").alias("restaurant_id"),
        (F.col("id") % 4).cast("int").alias("driver_id"), (F.col("id") % 7).cast("int").alias("agent_id"), F.lit("Open").alias("status"),
        (F.col("id") % 11 + shift).cast("decimal(10,2)").alias("refund_amount"), at.alias("created_at"),
        after(F.col("id") * 13 % 120).alias("first_response_at"), F.when((F.col("id") % 9 != 4) & (day != 7), after(F.col("id") * 97 % 2000 + shift)).alias("resolved_at"),
        after(F.lit(60)).alias("sla_first_due_at"), after(F.lit(900)).alias("sla_resolve_due_at"))
    return with_sla_flags(rows)


def same(wh):
    dims = [wh.read(t) for t in ("restaurants", "categories", "regions")]
    rows = lambda df: [tuple(r) for r in df.collect()]
    given = wh.read("tickets")
    assert states.sla_daily(wh).dtypes == views.sla_daily(given).dtypes
    assert rows(states.sla_daily(wh)) == rows(views.sla_daily(given))
    assert rows(states.sla_by_restaurant(wh)) == rows(views.sla_by_restaurant(given, *dims))
    assert rows(states.sla_by_driver(wh)) == rows(views.sla_by_driver(given, wh.read("drivers")))
    assert states.sla_by_driver(wh).dtypes == views.sla_by_driver(given, wh.read("drivers")).dtypes
    return rows(states.sla_health(wh))


def test_states(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    assert states.refresh(wh) == [] and states.sla_daily(wh).count() == 0
    wh.upsert("restaurants", spark.createDataFrame([(i, f"r{i}", 1, 1) for i in range(3)], "restaurant_id int, restaurant_name string, region_id int, category_id int"))
    wh.upsert("categories", spark.createDataFrame([(1, "c")], "category_id int, category_name string"))
    wh.upsert("regions", spark.createDataFrame([(1, "g")], "region_id int, region_name string"))
    wh.upsert("drivers", spark.createDataFrame([(i, f"d{i}") for i in range(4)], "driver_id int, driver_name string"))
    wh.upsert("tickets", tickets(spark, range(200)))
    assert len(states.refresh(wh)) == 20 and states.refresh(wh) == []
    health = same(wh)
    assert [str(r[0]) for r in health] == [f"2026-03-{d:02d}" for d in range(20, 13, -1)]
    # late and corrected tickets of three days
    wh.upsert("tickets", tickets(spark, [3, 203, 217, 18], shift=5))
    assert states.refresh(wh) == ["2026-03-04", "2026-03-18", "2026-03-19"]
    assert same(wh) != health
    opened = {f.split("/part=")[1].split("/")[0] for f in states.sla_health(wh).inputFiles()}
    assert opened == {f"2026-03-{d:02d}" for d in range(14, 21)}
    assert [str(r.day) for r in states.sla_summary(wh, "2026-03-04").collect()] == ["2026-03-04"]
    assert states.sla_summary(wh, "2026-03-07").collect() == []
    # a ticket that moves to another day leaves its old one
    wh.upsert("tickets", tickets(spark, [5]).withColumn("created_at", F.lit("2026-03-20 10:00:00").cast("timestamp_ntz")))
    assert states.refresh(wh) == ["2026-03-06", "2026-03-20"]
    same(wh)
