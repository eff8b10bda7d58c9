"""The commit log: bounded files, and several writers."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from ordergate import commits, warehouse
from ordergate.commits import CommitLog, Conflict, Entry
from ordergate.warehouse import Warehouse
from tests.test_warehouse import content, events


def test_files_and_names_do_not_grow_with_commits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 4)
    log, want = CommitLog(spark, f"{tmp_path}/commits"), {}
    for i in range(50):
        part, replaces = str(i % 3), i % 5 == 0
        log.commit(log.load().generation, [Entry("t", part, f"f{i}", replaces)], {"t": {"n": i}}, {"t"})
        want[part] = [*([] if replaces else want.get(part, [])), f"f{i}"]
    late = CommitLog(spark, f"{tmp_path}/commits")
    assert late.load() == log.load() and late.load().folders("t") == want and late.load().facts == {"t": {"n": 49}}
    assert late.files_read <= 5 and len(log.storage.names(log.folder)) <= 12
    late.commit(50, [Entry("t", "0", None, True)], {}, set())
    read = log.files_read
    assert "0" not in log.load().folders("t") and log.files_read - read <= 2


def test_a_reader_survives_the_removal_of_commits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    log, slow = (CommitLog(spark, f"{tmp_path}/commits") for _ in range(2))
    log.commit(0, [Entry("t", "a", "f0")], {}, set())
    real, passed = slow.storage.names, []

    def names(folder):  # lists, then sleeps over a dozen commits
        found = real(folder)
        if not passed:
            passed.append(1)
            for i in range(12):
                log.commit(0, [Entry("t", "a", f"g{i}")], {}, set())
        return found

    monkeypatch.setattr(slow.storage, "names", names)
    assert slow.load() == log.load() and len(slow.load().folders("t")["a"]) == 13


def test_each_generation_has_one_writer(spark, tmp_path):
    logs = [CommitLog(spark, f"{tmp_path}/commits") for _ in range(4)]

    def write(n):
        for i in range(6):
            logs[n].commit(0, [Entry("t", "a", f"{n}-{i}")], {}, set())

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    found = CommitLog(spark, f"{tmp_path}/commits").load().folders("t")["a"]
    assert sorted(found) == sorted(f"{n}-{i}" for n in range(4) for i in range(6))


def test_a_commit_is_refused_when_its_table_has_changed(spark, tmp_path):
    one, two = (Warehouse(spark, f"{tmp_path}/wh") for _ in range(2))
    writes = one.begin()
    assert writes.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01"))) == 1
    assert content(one) == {} and content(writes) == {"e1": ("Open", "2026-01-01")}
    two.upsert("teams", spark.createDataFrame([(1, "a")], "team_id int, team_name string"))
    two.upsert("ticket_events", events(spark, ("e2", "Open", "2026-01-01")))
    with pytest.raises(Conflict, match="fact_ticket_event"):
        writes.commit()
    assert set(content(one)) == {"e2"}
    other = one.begin()  # tables that nobody else writes don't stand in the way
    other.upsert("teams", spark.createDataFrame([(2, "b")], "team_id int, team_name string"))
    two.upsert("ticket_events", events(spark, ("e3", "Open", "2026-01-01")))
    other.commit()
    assert one.read("teams").count() == 2 and set(content(two)) == {"e2", "e3"}


def test_two_writers_lose_nothing(spark, tmp_path):
    def write(n):
        mine = Warehouse(spark, f"{tmp_path}/wh")
        for i in range(3):
            mine.upsert("ticket_events", events(spark, (f"e{n}-{i}", "Open", "2026-01-01"), ("shared", f"{n}", "2026-01-01")))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, range(2)))
    found = content(Warehouse(spark, f"{tmp_path}/wh"))
    assert set(found) == {"shared", *(f"e{n}-{i}" for n in range(2) for i in range(3))}


def test_vacuum_removes_what_no_part_refers_to(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "ATTEMPTS", 1)
    wh = Warehouse(spark, f"{tmp_path}/wh")
    wh.upsert("ticket_events", events(spark, ("e1", "Open", "2026-01-01")))
    lost = wh.begin()
    lost.upsert("ticket_events", events(spark, ("e1", "Closed", "2026-01-01")))
    assert wh.vacuum() == 0  # a run that is still under way
    assert wh.vacuum(older_than_seconds=-5) == 2  # rows and index
    assert content(wh) == {"e1": ("Open", "2026-01-01")}
