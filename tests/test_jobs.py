"""Whole jobs on hand-written files."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ordergate.operators import metrics
from ordergate.plans.batch import run_batch
from ordergate.plans.table_job import Run
from ordergate.streaming import run_once, watch
from ordergate.warehouse import Warehouse

DAY = "2026-02-22"


def put(path: Path, content) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, bytes):
        path.write_bytes(content)
    elif isinstance(content, str):
        path.write_text(content)
    else:
        path.write_text(json.dumps(content))


def snapshot(root: Path) -> None:
    day = root / "batch" / DAY
    put(day / "cities.json", [{"city_id": 1, "city_name": "Cairo", "country": "EG", "timezone": "x"}])
    put(day / "regions.csv", "region_id,region_name,city_id,delivery_base_fee\n1,North,1,10\n2,South,1,-5\n3,East,9,5\n")
    put(day / "segments.csv", "segment_id,segment_name,discount_pct,priority_support\n1,Gold,5,True\n")
    put(day / "categories.csv", "category_id,category_name\n1,Grill\n")
    put(day / "teams.csv", "team_id,team_name\n1,A\n")
    put(day / "reason_categories.csv", "reason_category_id,category_name\n1,Food\n")
    put(day / "reasons.csv", "reason_id,reason_name,reason_category_id,severity_level,typical_refund_pct\n1,Cold,1,3,0.5\n")
    put(day / "channels.csv", "channel_id,channel_name\n1,chat\n")
    put(day / "priorities.csv", "priority_id,priority_code,priority_name,sla_first_response_min,sla_resolution_min\n1,P1,Critical,1,15\n")
    put(day / "customers.csv",
        "customer_id,full_name,email,phone,region_id,segment_id,signup_date,gender,created_at,updated_at\n"
        "1,A,a@x.com,01012345678,1.0,1,2023-05-01,male,2023-05-01 00:00:00,2023-05-01\n"
        "1,A again,a@x.com,01012345678,1,1,2023-05-01,male,2023-05-01,2023-05-01\n"
        "2,B,notanemail,01012345678,1,1,N/A,male,2023-05-01,2023-05-01\n"
        "3,C,c@x.com,1012345678.0,1,1,invalid,female,2023-05-01,2023-05-01\n"
        ",D,d@x.com,01012345678,1,1,2023-05-01,male,2023-05-01,2023-05-01\n"
        "5,E,e@x.com,01012345678,77,1,2023-05-01,male,2023-05-01,2023-05-01\n")
    put(day / "restaurants.json", [
        {"restaurant_id": 1, "restaurant_name": "R", "region_id": 1, "category_id": 1, "price_tier": "$",
         "rating_avg": 4.5, "prep_time_avg_min": 10, "is_active": True,
         "created_at": "2023-05-01", "updated_at": "2023-05-01"},
        {"restaurant_id": 2, "restaurant_name": "S", "region_id": 1, "category_id": 1, "price_tier": "$",
         "rating_avg": 6, "prep_time_avg_min": 10, "is_active": True,
         "created_at": "2023-05-01", "updated_at": "2023-05-01"}])
    put(day / "drivers.csv",
        "driver_id,driver_name,driver_phone,national_id,region_id,shift,vehicle_type,hire_date,rating_avg,"
        "on_time_rate,cancel_rate,completed_deliveries,is_active,created_at,updated_at\n"
        "1,Dr,01112345678,123,1,day,bike,2022-01-01,4.2,0.9,0.1,100,True,2022-01-01,2022-01-01\n")
    put(day / "agents.csv",
        "agent_id,agent_name,agent_email,agent_phone,team_id,skill_level,hire_date,avg_handle_time_min,"
        "resolution_rate,csat_score,is_active,created_at,updated_at\n"
        "1,Ag,ag@x.com,01212345678,1,senior,2022-01-01,12,0.8,4.5,True,2022-01-01,2022-01-01\n")


def order(key, **more):
    row = {"order_id": key, "customer_id": 1, "restaurant_id": 1, "driver_id": 1, "region_id": 1,
           "order_amount": 100.0, "delivery_fee": 5, "discount_amount": 0, "total_amount": 105.5,
           "order_status": "Delivered", "payment_method": "card",
           "order_created_at": f"{DAY} 08:00:00", "delivered_at": f"{DAY} 08:40:00"}
    return {**row, **more}


TICKET_HEADER = (
    "ticket_id,order_id,customer_id,driver_id,restaurant_id,agent_id,reason_id,priority_id,channel_id,status,"
    "refund_amount,created_at,first_response_at,resolved_at,sla_first_due_at,sla_resolve_due_at\n")


def ticket(key, order_id, agent=1, status="Resolved", first="09:00:50"):
    return (f"{key},{order_id},1,1,1,{agent},1,1,1,{status},10.5,{DAY} 09:00:00,{DAY} {first},"
            f"{DAY} 09:20:00,{DAY} 09:01:00,{DAY} 09:15:00\n")


def slots(root: Path) -> None:
    day = root / "stream" / DAY
    put(day / "08" / "orders.json", [
        order("o1"), order("o1", order_status="Cancelled"), order("o2", customer_id=99),
        order("o3", total_amount=-1), order("o4", order_created_at="N/A")])
    put(day / "08" / "tickets.csv", TICKET_HEADER + ticket("t1", "o1") + ticket("t2", "o9"))
    put(day / "08" / "ticket_events.json", [
        {"event_id": "e1", "ticket_id": "t1", "agent_id": 1, "event_ts": f"{DAY} 09:00:00",
         "old_status": None, "new_status": "Open", "notes": None},
        {"event_id": "e2", "ticket_id": "t3", "agent_id": 1, "event_ts": f"{DAY} 09:00:00",
         "old_status": None, "new_status": "Open", "notes": None}])
    put(day / "10" / "orders.json", [order("o1", order_status="Refunded"), order("o9")])
    put(day / "10" / "tickets.csv", TICKET_HEADER + ticket("t3", "o9", first="09:02:00"))
    put(day / "12" / "orders.json", "[]")
    put(day / "12" / "tickets.csv", TICKET_HEADER)
    put(day / "12" / "ticket_events.json", '[{"event_id": 1')


def make_run(spark, root: Path, **more) -> Run:
    return Run(spark, Warehouse(spark, f"{root}/wh"), f"{root}/quarantine", f"{root}/staging", DAY, **more)


def status_by_file(df):
    return {r["_file"].split(f"/{DAY}/")[1]: (r.status, r.rows_loaded, r.rows_rejected) for r in df.collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    snapshot(root)
    slots(root)
    batch = status_by_file(run_batch(make_run(spark, root), f"{root}/batch"))
    stream = status_by_file(run_once(make_run(spark, root), f"{root}/stream"))
    return root, batch, stream


def test_batch_outcomes(spark, loaded):
    root, batch, _ = loaded
    assert batch["cities.json"] == ("success", 1, 0)
    # One negative fee, one unknown city.
    assert batch["regions.csv"] == ("success", 1, 2)
    assert batch["customers.csv"] == ("success", 2, 2)
    assert batch["restaurants.json"] == ("success", 1, 1)
    customers = Warehouse(spark, f"{root}/wh").read("customers").orderBy("customer_id").collect()
    assert [(c.customer_id, c.full_name, c.region_id) for c in customers] == [(1, "A", 1), (3, "C", 1)]
    assert len(customers[0].email_hash) == 64 and customers[0].phone_hash == customers[1].phone_hash


def test_stream_outcomes(spark, loaded):
    _, _, stream = loaded
    assert stream["08/orders.json"] == ("success", 1, 3)
    assert stream["10/orders.json"] == ("success", 2, 0)
    assert stream["12/orders.json"] == ("skipped", 0, 0)
    assert stream["08/tickets.csv"] == ("success", 1, 1)  # o9 arrives two slots later
    assert stream["10/tickets.csv"] == ("success", 1, 0)
    assert stream["12/tickets.csv"] == ("skipped", 0, 0)
    assert stream["08/ticket_events.json"] == ("success", 1, 1)
    assert stream["12/ticket_events.json"][0] == "failed"


def test_later_slot_wins_and_flags(spark, loaded):
    wh = Warehouse(spark, f"{loaded[0]}/wh")
    orders = {r.order_id: r.order_status for r in wh.read("orders").collect()}
    assert orders == {"o1": "Refunded", "o9": "Delivered"}
    flags = {r.ticket_id: (r.is_first_response_breached, r.is_resolution_breached,
                           r.first_response_seconds, float(r.resolution_minutes))
             for r in wh.read("tickets").collect()}
    assert flags == {"t1": (False, True, 50, 20.0), "t3": (True, True, 120, 20.0)}


def test_audit_and_quarantine(spark, loaded):
    root = loaded[0]
    log = Warehouse(spark, f"{root}/wh").quality_log()
    orders = log.where("source_file like '%/08/orders.json'").collect()
    assert len(orders) == 1
    row = orders[0]
    assert (row.total_records, row.valid_records, row.rejected_records, row.duplicate_count,
            row.null_violation_count, row.invalid_format_count, row.orphan_count) == (5, 1, 3, 1, 1, 1, 1)
    assert float(row.orphan_rate) == 0.5
    assert log.where("source_file like '%/12/%'").count() == 0
    bad = spark.read.option("header", True).csv(
        f"{root}/quarantine/run_date={DAY}/table_name=orders/reason=orphan_reference")
    assert [(r.order_id, r.orphan_fk_col, r.orphan_fk_value) for r in bad.collect()] == [("o2", "customer_id", "99")]
    assert metrics.run_summary(log, DAY).collect()[0].files_processed > 10


def test_rerun_changes_nothing(spark, loaded):
    root = loaded[0]
    wh = Warehouse(spark, f"{root}/wh")
    before = {t: sorted(map(str, wh.read(t).collect())) for t in ("customers", "orders", "tickets", "ticket_events")}
    again = run_batch(make_run(spark, root), f"{root}/batch")
    assert {r.status for r in again.collect()} == {"already_processed"}
    summary = metrics.batch_summary(again).collect()[0]
    assert (summary.files_attempted, summary.files_skipped) == (13, 13)
    stream = status_by_file(run_once(make_run(spark, root), f"{root}/stream"))
    assert set(stream) == {"12/orders.json", "12/tickets.csv", "12/ticket_events.json"}
    after = {t: sorted(map(str, wh.read(t).collect())) for t in before}
    assert before == after


def test_watch_loads_new_and_changed_files(spark, tmp_path):
    snapshot(tmp_path)
    slots(tmp_path)
    run_batch(make_run(spark, tmp_path), f"{tmp_path}/batch")
    seen = []
    for _ in range(2):
        query = watch(make_run(spark, tmp_path), f"{tmp_path}/stream", f"{tmp_path}/ckpt", None, rescan=True,
                      on_status=lambda s: seen.append(status_by_file(s)))
        query.awaitTermination(120)
        assert query.exception() is None
        put(tmp_path / "stream" / DAY / "14" / "orders.json", [order("o7")])
        put(tmp_path / "stream" / DAY / "10" / "orders.json", [order("o1", order_status="Late"), order("o9")])
    assert len(seen) == 2
    assert seen[1]["14/orders.json"] == ("success", 1, 0)
    assert seen[1]["10/orders.json"] == ("success", 2, 0)
    orders = Warehouse(spark, f"{tmp_path}/wh").read("orders")
    assert {r.order_id: r.order_status for r in orders.collect()} == {
        "o1": "Late", "o9": "Delivered", "o7": "Delivered"}


def test_incremental_flags_stay(spark, tmp_path):
    snapshot(tmp_path)
    slots(tmp_path)
    keep = {"recompute_sla": False}
    run_batch(make_run(spark, tmp_path), f"{tmp_path}/batch")
    run_once(make_run(spark, tmp_path, **keep), f"{tmp_path}/stream")
    put(tmp_path / "stream" / DAY / "14" / "tickets.csv",
        TICKET_HEADER + ticket("t1", "o1", status="Closed", first="09:05:00"))
    run_once(make_run(spark, tmp_path, **keep), f"{tmp_path}/stream")
    row = Warehouse(spark, f"{tmp_path}/wh").read("tickets").where(F.col("ticket_id") == "t1").collect()[0]
    assert (row.status, row.is_first_response_breached, row.first_response_seconds) == ("Closed", False, 50)


class Failing:
    """A warehouse whose writes to one table raise."""

    def __init__(self, inner, table):
        self.inner, self.table = inner, table

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def begin(self):
        return Failing(self.inner.begin(), self.table)

    def upsert(self, name, *args, **more):
        if name == self.table:
            raise RuntimeError("no space")
        return self.inner.upsert(name, *args, **more)


def ledger_states(run):
    return {(Path(r["file_path"]).name, r["status"]) for r in run.warehouse.ledger().collect()}


def test_a_failing_table_stops_no_other(spark, tmp_path):
    snapshot(tmp_path)
    slots(tmp_path)
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")

    def with_failing(table):
        run = make_run(spark, tmp_path)
        run.warehouse = Failing(run.warehouse, table)
        return run

    found = {Path(r["_file"]).name: r for r in run_batch(with_failing("categories"), batch).collect()}
    assert found["categories.csv"]["status"] == "failed" and "no space" in found["categories.csv"]["error"]
    assert found["cities.json"]["status"] == found["agents.csv"]["status"] == "success"
    run = make_run(spark, tmp_path)
    assert {("categories.csv", "failed"), ("segments.csv", "success"), ("customers.csv", "success")} <= ledger_states(run)

    found = run_once(with_failing("orders"), stream).collect()
    assert {r["status"] for r in found if r["table_name"] == "orders"} == {"failed"}
    assert {r["table_name"] for r in found} == {"orders", "tickets", "ticket_events"}
    # failed files are tried again
    assert "success" in {r["status"] for r in run_once(run, stream).collect() if r["table_name"] == "orders"}
    run_batch(make_run(spark, tmp_path), batch)
    assert ("categories.csv", "success") in ledger_states(run)


def test_watch_survives_a_failing_scan(spark, tmp_path, monkeypatch):
    import sys

    snapshot(tmp_path)
    slots(tmp_path)
    run = make_run(spark, tmp_path)
    run_batch(run, str(tmp_path / "batch"))

    def broken(*_):
        raise RuntimeError("listing failed")

    seen = []
    module = sys.modules["ordergate.streaming.watch"]
    with monkeypatch.context() as m:
        m.setattr(module, "run_once", broken)
        watch(run, str(tmp_path / "stream"), str(tmp_path / "ckpt"), poll_seconds=None, on_status=seen.append).awaitTermination()
    assert not seen
    put(tmp_path / "stream" / DAY / "23" / "orders.json", [order("late")])
    watch(run, str(tmp_path / "stream"), str(tmp_path / "ckpt"), poll_seconds=None, on_status=seen.append).awaitTermination()
    assert run.warehouse.read("orders").count() > 1 and seen


class Killed(BaseException):
    """The process ends: nothing catches this, and nothing is cleaned up."""


def lookups(root):
    """A snapshot of two tables in which rows are loaded, rejected and refused, and a file fails."""
    day = root / "batch" / DAY
    put(day / "cities.json", [{"city_id": i, "city_name": f"c{i}", "country": "EG", "timezone": "x"} for i in (1, 2)] + [{"city_id": 3, "city_name": None, "country": "", "timezone": ""}])
    put(day / "regions.csv", "region_id,region_name,city_id,delivery_base_fee\n1,North,1,10\n2,South,1,-5\n3,East,9,5\n")
    put(day / "teams.csv", "team_id\n1\n")


def left_by(spark, root):
    """All that runs have left: rows of the warehouse, ledger, audit, alerts and quarantine (without names of this root, and times)."""
    wh = Warehouse(spark, f"{root}/wh")
    plain = lambda df: sorted(str(tuple(r)).replace(str(root), "") for r in df.drop("processing_latency_ms").collect())
    bad = {(t, r): plain(rows) for t in ("cities", "regions") for r in ("data_validation", "warehouse_constraint")
           if (rows := wh.quarantined(t, r)) is not None}
    return [*(plain(wh.read(t)) for t in ("cities", "regions", "teams")), plain(wh.ledger()), plain(wh.quality_log()), plain(wh.alerts()), bad]


def test_a_run_that_is_lost_leaves_nothing_and_repeats_nothing(spark, tmp_path, monkeypatch):
    """Killed after each of its steps and started again, a run leaves what an undisturbed one does."""
    from ordergate import commits, storage
    from ordergate.operators import quarantine
    from ordergate.warehouse import Transaction

    def load(root):
        return run_batch(make_run(spark, root, run_timestamp="2026-02-22 12:00:00"), f"{root}/batch", ["cities", "regions", "teams"], parallel=1)

    lookups(tmp_path / "calm")
    load(tmp_path / "calm")
    want = left_by(spark, tmp_path / "calm")
    assert [bool(w) for w in want] == [True, True, False, True, True, True, True] and len(want[-1]) == 3
    steps = [(Transaction, "upsert"), (quarantine, "write"), (Transaction, "append_quality"), (Transaction, "record_files"),
             (storage.Storage, "create"), (commits.CommitLog, "commit")]
    for where, step in steps:
        root = tmp_path / step
        lookups(root)
        real, done = getattr(where, step), []

        def last_breath(*args, real=real, done=done, **more):
            if step == "create":  # the commit file itself
                raise Killed
            result = real(*args, **more)
            done.append(1)
            raise Killed

        with monkeypatch.context() as m:
            m.setattr(where, step, last_breath)
            with pytest.raises(Killed):
                load(root)
        after = left_by(spark, root)
        assert after == (want if step == "commit" else [[], [], [], [], [], [], {}]), step
        again = {Path(r["_file"]).name: r.status for r in load(root).collect()}
        assert again["teams.csv"] == "failed" and again["cities.json"] == ("already_processed" if step == "commit" else "success")
        if step != "commit":  # there the file that failed is tried, and audited, again
            assert left_by(spark, root) == want, step


def test_alerts_of_a_run(spark, loaded):
    alerts = {(r.kind, r.source_file.split(f"/{DAY}/")[1]): (r.affected_rows, r.total_rows) for r in Warehouse(spark, f"{loaded[0]}/wh").alerts().collect()}
    assert alerts == {("file_failed", "12/ticket_events.json"): (None, None), ("orphan_rate", "08/orders.json"): (1, 2),
                      ("orphan_rate", "08/tickets.csv"): (1, 2), ("orphan_rate", "08/ticket_events.json"): (1, 2)}


def test_quarantine_files_are_gzipped(spark, tmp_path):
    from ordergate.operators import quarantine
    folder = quarantine.write(spark.range(3).withColumn("_file", F.lit("x")), str(tmp_path), "orders", "data_validation", DAY, "b")
    files = [n for n in os.listdir(folder) if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
    assert sorted(r.id for r in spark.read.option("header", True).csv(folder).collect()) == ["0", "1", "2"]


def test_committed_quarantine_and_removed_staging(spark, loaded):
    root = loaded[0]
    bad = Warehouse(spark, f"{root}/wh").quarantined("orders", "orphan_reference", DAY)
    assert [(r.order_id, r.orphan_fk_col) for r in bad.collect()] == [("o2", "customer_id")]
    assert Warehouse(spark, f"{root}/wh").quarantined("orders", "orphan_reference", "2000-01-01") is None
    assert all(p.name.endswith("-files") for run in (root / "staging").iterdir() for p in run.iterdir())


def test_a_large_json_file_loads_and_a_broken_one_fails_alone(spark, tmp_path, monkeypatch):
    """Parts that are read by their members beside a loaded one: the loaded one's ledger row stays, nothing is loaded twice."""
    from ordergate.sources import files, json_files

    day = tmp_path / "batch" / DAY / "cities.json"
    city = lambda *ids: [{"city_id": i, "city_name": f"c{i}", "country": "EG", "timezone": "x"} for i in ids]
    put(day / "a.json", city(1))
    load = lambda: {Path(r["_file"]).name: (r.status, r.rows_loaded, r.error) for r in run_batch(make_run(spark, tmp_path), f"{tmp_path}/batch", ["cities"]).collect()}
    assert load()["a.json"][:2] == ("success", 1)
    ledger = lambda: {Path(r.file_path).name: (r.status, r.md5_hash) for r in make_run(spark, tmp_path).warehouse.ledger().collect()}
    before = ledger()["a.json"]
    put(day / "b.json", city(2, 3, 3, 3))
    put(day / "c.json", city(4))
    with monkeypatch.context() as m:
        m.setattr(files, "LARGEST_FILE", 150)
        m.setattr(json_files, "SPLIT_FROM", 100)
        (day / "d.json").write_text('[{"city_id": 5, "city_name": "' + "x" * 200)
        found = load()
        assert found["a.json"][0] == "already_processed" and found["b.json"][:2] == ("success", 2) and found["c.json"][:2] == ("success", 1)
        assert found["d.json"] == ("failed", 0, "Malformed JSON")
        assert ledger()["a.json"] == before and ledger()["b.json"][0] == "success" and ledger()["d.json"][0] == "failed"
        assert [load()[f"{f}.json"][0] for f in "abcd"] == ["already_processed"] * 3 + ["failed"]
    log = make_run(spark, tmp_path).warehouse.quality_log()
    assert sorted(Path(r.source_file).name for r in log.collect()) == ["a.json", "b.json", "c.json"]
    assert {r.city_id for r in make_run(spark, tmp_path).warehouse.read("cities").collect()} == {1, 2, 3, 4}


def test_checks_read_only_the_buckets_they_need(spark, tmp_path, monkeypatch):
    """With many buckets the same rows pass and fail, and keys of a parent are read by the values at hand."""
    from ordergate import warehouse
    from ordergate.operators.references import warehouse_keys

    monkeypatch.setattr(warehouse, "BUCKET_KEYS", 1)
    slots(tmp_path)
    run = make_run(spark, tmp_path)
    for name, key, ids in (("customers", "customer_id", (1, 3, 5, 7)), ("agents", "agent_id", (1, 2, 3))):
        run.warehouse.upsert(name, spark.createDataFrame([(i,) for i in ids], f"{key} int"))
    assert run.warehouse.buckets("customers") > 1
    stream = status_by_file(run_once(make_run(spark, tmp_path), f"{tmp_path}/stream"))
    assert (stream["08/orders.json"], stream["08/tickets.csv"], stream["10/tickets.csv"]) == (("success", 1, 3), ("success", 1, 1), ("success", 1, 0))
    near = spark.createDataFrame([("o1",), ("nothing",)], "k string")
    keys = warehouse_keys(run.warehouse, "orders")
    assert keys.some and {r.order_id for r in keys.near(near).collect()} >= {"o1"}
    assert len(keys.near(near).inputFiles()) <= 2 <= run.warehouse.buckets("orders")
    put(tmp_path / "stream" / DAY / "14" / "tickets.csv", TICKET_HEADER + ticket("t8", "o9") + ticket("t9", "o77") + ticket("t10", "o1", agent=4))
    later = status_by_file(run_once(make_run(spark, tmp_path), f"{tmp_path}/stream"))
    assert later["14/tickets.csv"] == ("success", 1, 2)


def test_other_dates_in_paths_do_not_matter(spark, tmp_path):
    """A day's files are found in the ledger wherever they lie, also below and above folders named by other dates."""
    day = tmp_path / "2025-01-01" / "batch" / DAY
    put(day / "categories.csv" / "2024-05-05" / "a.csv", "category_id,category_name\n1,Grill\n")
    load = lambda: [r.status for r in run_batch(make_run(spark, tmp_path), f"{tmp_path}/2025-01-01/batch", ["categories"]).collect()]
    assert (load(), load()) == (["success"], ["already_processed"])


def test_json_files_are_parsed_once(spark, tmp_path, monkeypatch):
    """A load parses each file once, and bad files beside good ones give no rows but their errors."""
    from ordergate.sources import json_files

    day = tmp_path / "batch" / DAY / "cities.json"
    city = lambda i, **more: {"city_id": i, "city_name": f"c{i}", "country": "EG", "timezone": "x", **more}
    cases = {
        "good": [city(1), city(1, city_name="again"), {"city_id": 2}], "parts": [{"city_id": 3, "city_name": "c"}, {"city_id": 3, "country": "EG", "timezone": None}],
        "lacking": [{"city_id": 4, "city_name": "c"}], "broken": '[{"city_id": 5, "city_name": "c", "country": "EG", "timezone": "x"}, {"city_id": 6', "empty": "[]",
        "blank": " ", "scalar": "5", "unkeyed": [{**city(7), "city_id": None}]}
    for name, content in cases.items():
        put(day / f"{name}.json", content)
    parsed, members = [], json_files._members
    monkeypatch.setattr(json_files, "_members", lambda spark, paths, spec: (parsed.extend(paths), members(spark, paths, spec))[1])
    run = make_run(spark, tmp_path)
    found = {Path(r["_file"]).stem: (r.status, r.rows_loaded, r.error) for r in run_batch(run, f"{tmp_path}/batch", ["cities"]).collect()}
    assert sorted(Path(p).stem for p in parsed) == sorted(cases)
    assert found == {
        "good": ("success", 1, None), "parts": ("success", 1, None), "lacking": ("failed", 0, "Missing required columns: country, timezone"),
        "broken": ("failed", 0, "Malformed JSON"), "empty": ("skipped", 0, None), "blank": ("failed", 0, "Malformed JSON"), "scalar": ("failed", 0, "Malformed JSON"),
        "unkeyed": ("skipped", 0, None)}
    assert {(r.city_id, r.city_name) for r in run.warehouse.read("cities").collect()} == {(1, "c1"), (3, "c")}
