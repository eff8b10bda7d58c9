"""Versioned tables: what is rewritten, what survives a lost job."""

from pathlib import Path

from pyspark.sql import functions as F

from ordergate import warehouse
from ordergate.warehouse import Warehouse


def events(spark, *rows):
    df = spark.createDataFrame(list(rows), "event_id string, new_status string, event_ts string")
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def content(wh):
    return {r.event_id: (r.new_status, str(r.event_ts)[:10]) for r in wh.read("ticket_events").collect()}


def folders(wh):
    return wh._folders("fact_ticket_event")[1]


def test_new_keys_add_files_and_known_keys_rewrite_their_part(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    assert wh.read("ticket_events").count() == 0
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01"), ("e2", "Open", "2026-01-02")))
    wh.upsert("ticket_events", events(spark, ("e3", "Open", "2026-01-01")))
    assert {p: len(f) for p, f in folders(wh).items()} == {"2026-01-01": 2, "2026-01-02": 1}
    before = folders(wh)["2026-01-02"]
    wh.upsert("ticket_events", events(spark, ("e1", "Closed", "2026-01-01")))
    assert len(folders(wh)["2026-01-01"]) == 1 and folders(wh)["2026-01-02"] == before
    assert content(wh) == {
        "e1": ("Closed", "2026-01-01"), "e2": ("Open", "2026-01-02"), "e3": ("Open", "2026-01-01")}


def test_a_row_may_move_to_another_day(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01"), ("e2", "Open", "2026-01-02")))
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-02")))
    assert content(wh) == {"e1": ("Open", "2026-01-02"), "e2": ("Open", "2026-01-02")}
    assert "2026-01-01" not in folders(wh)
    assert wh.read("ticket_events", first="2026-01-02", last="2026-01-02").count() == 2


def test_columns_not_given_keep_their_value(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01")))
    wh.upsert("ticket_events", spark.createDataFrame([("e1", "n")], "event_id string, notes string"))
    row = wh.read("ticket_events").collect()[0]
    assert (row.new_status, row.notes, str(row.event_ts)[:10]) == ("Open", "n", "2026-01-01")


def test_files_of_a_lost_job_stay_invisible(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01")))
    stray = Path(f"{tmp_path}/wh/fact_ticket_event/data/g=000000009-dead")
    events(spark, ("e9", "Open", "2026-01-01")).withColumn("part", F.lit("2026-01-01")).write.partitionBy(
        "part").parquet(str(stray))
    assert set(content(wh)) == {"e1"}


def test_compaction_keeps_rows(spark, tmp_path):
    wh = Warehouse(spark, f"{tmp_path}/wh")
    for i in range(3):
        wh.upsert("ticket_events", events(spark, (f"e{i}", "Open", "2026-01-01")))
    before = content(wh)
    wh.compact("ticket_events")
    assert len(folders(wh)["2026-01-01"]) == 1 and content(wh) == before


def index_of(wh):
    return sorted((r.event_id, r["at"]) for r in wh.key_parts("ticket_events").collect())


def test_key_index_follows_the_table(spark, tmp_path, monkeypatch):
    """Buckets double, folders are joined, keys move: the index still says where each key is."""
    monkeypatch.setattr(warehouse, "BUCKET_KEYS", 5)
    monkeypatch.setattr(warehouse, "BUCKET_FOLDERS", 2)
    wh, want = Warehouse(spark, f"{tmp_path}/wh"), {}
    for day in range(1, 6):
        rows = [(f"e{day}-{i}", "Open", f"2026-01-{day:02d}") for i in range(6)] + [("mover", "Open", f"2026-01-{day:02d}")]
        assert wh.upsert("ticket_events", events(spark, *rows)) == 7
        want |= {k: ("Open", d) for k, _, d in rows}
        assert content(wh) == want
        assert {k for k, _ in index_of(wh)} == set(want) and {(k, d) for k, (_, d) in want.items()} <= set(index_of(wh))
        assert sorted(r.event_id for r in wh.keys("ticket_events").collect()) == sorted(want)
    assert wh.buckets("ticket_events") >= 8
    assert {p: len(f) for p, f in folders(wh).items()}["2026-01-05"] == 1


def test_files_of_a_small_load_do_not_grow_with_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "BUCKET_KEYS", 4)
    monkeypatch.setattr(warehouse, "BUCKET_FOLDERS", 3)
    wh, few = Warehouse(spark, f"{tmp_path}/wh"), spark.createDataFrame([("e1-1",), ("none",)], "k string")
    days = [(f"e{d}-{i}", "Open", f"2026-{1 + d // 28:02d}-{1 + d % 28:02d}") for d in range(60) for i in range(3)]
    counts = []
    for low in (0, 90):
        wh.upsert("ticket_events", events(spark, *days[low : low + 90]))
        counts.append(len(wh.key_parts("ticket_events", few).inputFiles()))
    assert len(folders(wh)) == 60 and max(counts) <= 2 * (warehouse.BUCKET_FOLDERS + 1)
    found = {(r.event_id, r["at"]) for r in wh.key_parts("ticket_events", few).collect()}
    assert ("e1-1", "2026-01-02") in found and len(found) < 180 / 4
    before = folders(wh)
    wh.upsert("ticket_events", events(spark, ("e1-1", "Closed", "2026-01-02")))
    assert [p for p in before if folders(wh)[p] != before[p]] == ["2026-01-02"]
    # an index that is not there is made when it is needed
    monkeypatch.setattr(warehouse, "_index", lambda spec: f"{spec.warehouse_name}_keys2")
    wh.upsert("ticket_events", events(spark, ("e2-1", "Closed", "2026-01-03")))
    assert wh.keys("ticket_events").count() == 180 and content(wh)["e2-1"][0] == "Closed"


def test_ledger_days_are_added_to_and_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "LEDGER_FOLDERS", 3)
    wh = Warehouse(spark, f"{tmp_path}/wh")

    def record(minute, *entries):
        rows = [(f"in/{path}", "m", f"2026-01-01 00:{minute:02d}:00", status, minute, 0) for path, status in entries]
        df = spark.createDataFrame(rows, "file_path string, md5_hash string, processed_at string, status string, rows_loaded long, rows_rejected long")
        wh.record_files(df.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz")))

    record(0, ("2026-01-01/a", "failed"), ("2026-01-02/a", "success"), ("x", "skipped"))
    old = wh._folders("file_ledger")[1]["2026-01-01"]
    for minute in range(1, 6):
        record(minute, ("2026-01-02/a", "success"), ("2026-01-02/b", "failed"))
    now = wh._folders("file_ledger")[1]
    assert now["2026-01-01"] == old and len(now["2026-01-02"]) <= 3 and "all" in now
    assert {(r.file_path, r.status, r.rows_loaded) for r in wh.ledger().collect()} == {
        ("in/2026-01-01/a", "failed", 0), ("in/x", "skipped", 0), ("in/2026-01-02/a", "success", 5), ("in/2026-01-02/b", "failed", 5)}
    assert {r.file_path for r in wh.ledger("2026-01-01").collect()} == {"in/2026-01-01/a", "in/x"}
