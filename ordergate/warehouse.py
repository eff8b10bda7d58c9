"""Star-schema tables, the file ledger, audit, alerts and quarantine as parts of one versioned warehouse.

A table is folders of parquet files, partitioned by ``part``. The commit log says which folders make
up each part now. Rows with new keys are added beside a part's existing files; only parts
that hold a key of the load are rewritten. Which these are is answered by a *key index* kept beside
each table: (key, part) by hash of the key, of which a load reads only the buckets its keys fall in.

Everything a run writes becomes visible by one commit: warehouse rows, index, quarantine, audit, alerts
and ledger together (:meth:`Warehouse.begin`). Readers see the state before or after, never a mix, and a job
lost half-way leaves nothing but stray files. Several writers may work at once: a commit is
refused if a table it depends on has changed meanwhile, and single writes are then tried again.
"""

from __future__ import annotations

import math
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.commits import CommitLog, Conflict, Entry, Folders, State
from ordergate.operators.merge import last_per_key, merge
from ordergate.registry import ALERT_SCHEMA, QUALITY_LOG_SCHEMA, TableSpec, table
from ordergate.session import local_frame
from ordergate.sources.ledger import LEDGER_SCHEMA

LEDGER, QUALITY, ALERTS, QUARANTINE = "file_ledger", "quality_log", "alerts", "quarantine"
_WHOLE = "all"
_DAY = r".*(?:^|/)(\d{4}-\d{2}-\d{2})/"
#: Of the key index: keys of a bucket before buckets are doubled, folders of a bucket before they are joined.
BUCKET_KEYS, BUCKET_FOLDERS = 1_000_000, 8
#: Folders of a ledger day before they are joined.
LEDGER_FOLDERS = 16
ATTEMPTS = 10


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")

    # Reading ---------------------------------------------------------------

    def _state(self) -> State:
        return self.log.load()

    def _folders(self, name: str) -> tuple[int, Folders]:
        """Last generation and the live folders of each part: table metadata only."""
        state = self._state()
        return state.generation, state.folders(name)

    def _read(self, name: str, schema: T.StructType, folders: Folders, generation: bool = False) -> DataFrame:
        """Rows of the given parts, with their ``part``, and ``g``, which grows with the write they come from, if asked for."""
        paths = sorted(f"{self.root}/{f}/part={part}" for part, where in folders.items() for f in where)
        full = T.StructType([
            *schema, T.StructField("g", T.StringType()), T.StructField("part", T.StringType())])
        if paths:
            reader = self.spark.read.schema(full).option("basePath", f"{self.root}/{name}/data")
            rows = reader.parquet(*paths)
        else:
            rows = local_frame(self.spark, [], full)
        return rows if generation else rows.drop("g")

    def read(self, name: str, first: str = "", last: str = "~") -> DataFrame:
        """A registered table by source or warehouse name; empty if never written.

        ``first`` and ``last`` limit a date-partitioned fact to a range of days
        before any file is opened.
        """
        spec = table(name)
        folders = self._state().folders(spec.warehouse_name)
        wanted = {p: f for p, f in folders.items() if first <= p <= last}
        return self._read(spec.warehouse_name, spec.warehouse_schema, wanted).drop("part")

    def days(self, name: str) -> list[str]:
        """The parts of a date-partitioned fact that have files, in order."""
        return sorted(self._state().folders(table(name).warehouse_name))

    def ledger(self, run_date: str | None = None) -> DataFrame:
        """The latest entry of each file; if a date is given, of the files of that day's runs and of those of no day."""
        folders = self._state().folders(LEDGER)
        if run_date is not None:
            folders = {p: f for p, f in folders.items() if p in (run_date, _WHOLE)}
        return _latest(self._read(LEDGER, LEDGER_SCHEMA, folders, generation=True)).drop("part")

    def quality_log(self) -> DataFrame:
        return self._read(QUALITY, QUALITY_LOG_SCHEMA, self._state().folders(QUALITY)).drop("part")

    def alerts(self) -> DataFrame:
        return self._read(ALERTS, ALERT_SCHEMA, self._state().folders(ALERTS)).drop("part")

    def quarantined(self, name: str, reason: str, run_date: str | None = None) -> DataFrame | None:
        """Committed quarantine rows of a table and reason, all columns as text; None if there are none."""
        wanted = [
            f for part, folders in self._state().folders(QUARANTINE).items() for f in folders
            if part.split("/")[1:] == [name, reason] and run_date in (None, part.split("/")[0])]
        return self.spark.read.option("header", True).csv(wanted) if wanted else None

    # The key index -----------------------------------------------------------

    def _key_schema(self, spec: TableSpec) -> T.StructType:
        return T.StructType([T.StructField(spec.key, spec.warehouse_schema[spec.key].dataType), T.StructField("at", T.StringType())])

    def buckets(self, name: str) -> int:
        """How many buckets the index of a table has."""
        return self._state().facts.get(_index(table(name)), {}).get("buckets", 1)

    def has_keys(self, name: str) -> bool:
        return bool(self._state().folders(table(name).warehouse_name))

    def key_parts(self, name: str, near: DataFrame | None = None) -> DataFrame:
        """Rows (key, at): in which parts a key may be. ``near``, one column of values, leaves out buckets that none of them falls in."""
        spec, state = table(name), self._state()
        folders = state.folders(_index(spec))
        if state.folders(spec.warehouse_name) and not folders:  # written before there was an index
            rows = self._read(spec.warehouse_name, spec.warehouse_schema, state.folders(spec.warehouse_name))
            return rows.select(spec.key, F.col("part").alias("at"))
        if near is not None and self.buckets(name) > 1:
            wanted = self._buckets_of(spec, near)
            folders = {p: f for p, f in folders.items() if p in wanted}
        return self._read(_index(spec), self._key_schema(spec), folders).select(spec.key, "at")

    def keys(self, name: str, near: DataFrame | None = None) -> DataFrame:
        """The keys of a table, each once; of those buckets only that a value of ``near`` falls in."""
        spec = table(name)
        found = self.key_parts(name, near).select(spec.key)
        return found if spec.partition_by is None else found.distinct()  # a key that has moved is there twice

    def _buckets_of(self, spec: TableSpec, values: DataFrame) -> set[str]:
        key = F.col(values.columns[0]).try_cast(spec.warehouse_schema[spec.key].dataType)
        found = values.select(_bucket(key, self.buckets(spec.name)).alias("b")).distinct()
        return {r.b for r in found.collect() if r.b is not None}

    # Writing ---------------------------------------------------------------

    def begin(self) -> Transaction:
        """Writes that become visible together, by :meth:`Transaction.commit`."""
        return Transaction(self)

    def transact(self, work: Callable[[Transaction], object]):
        """``work`` as a transaction of its own, done again if another writer was first."""
        for attempt in range(ATTEMPTS):
            writes = self.begin()
            try:
                result = work(writes)
                writes.commit()
                return result
            except Conflict:
                writes.abort()
                if attempt == ATTEMPTS - 1:
                    raise
            except Exception:
                writes.abort()
                raise
        return None

    def upsert(self, name: str, rows: DataFrame, order: tuple[str, ...] = ()) -> int:
        """Merge ``rows`` into a table by its key; ``order`` decides between copies. Returns the number of rows merged."""
        return self.transact(lambda writes: writes.upsert(name, rows, order))

    def record_files(self, outcomes: DataFrame, run_date: str | None = None) -> None:
        self.transact(lambda writes: writes.record_files(outcomes, run_date))

    def append_quality(self, rows: DataFrame) -> None:
        self.transact(lambda writes: writes.append_quality(rows))

    def append_alerts(self, rows: DataFrame) -> None:
        self.transact(lambda writes: writes.append_alerts(rows))

    def update_where(self, name: str, needed: Column, change: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite the parts that have a row for which ``needed`` holds."""
        self.transact(lambda writes: writes.update_where(name, needed, change))

    def compact(self, name: str) -> None:
        """Rewrite a table's parts into as few files as their size asks for."""
        self.update_where(name, F.lit(True), lambda rows: rows)

    def vacuum(self, older_than_seconds: float = 7 * 24 * 3600) -> int:
        """Delete folders that no part refers to (lost jobs, replaced files) and that are older than any reader or run; returns how many."""
        state, storage, gone = self._state(), self.log.storage, 0
        live = {f for parts in state.tables.values() for folders in parts.values() for f in folders}
        for name in storage.names(self.root):
            for folder in storage.names(f"{self.root}/{name}/data"):
                path = f"{name}/data/{folder}"
                if path not in live and storage.modified(f"{self.root}/{path}") <= time.time() - older_than_seconds:
                    storage.delete(f"{self.root}/{path}")
                    gone += 1
        return gone


class Transaction(Warehouse):
    """A warehouse as of its beginning plus its own writes; others see them once it is committed.

    ``nested`` writes join this transaction by their own commit, or leave no trace.
    """

    def __init__(self, warehouse: Warehouse) -> None:
        self.spark, self.root, self.log, self.outer = warehouse.spark, warehouse.root, warehouse.log, warehouse
        self.current = warehouse._state()
        self.base = self.current.generation
        self.entries: list[Entry] = []
        self.facts: dict[str, dict] = {}
        self.depends: set[str] = set()
        self.lock = threading.Lock()

    def _state(self) -> State:
        return self.current

    def _add(self, entries: list[Entry], facts: dict[str, dict] | None = None) -> None:
        with self.lock:
            self.entries += entries
            self.facts |= facts or {}
            self.current = self.current.after(self.base, entries, facts or {})

    def commit(self) -> None:
        if not self.entries:
            return
        if isinstance(self.outer, Transaction):
            self.outer.depends |= self.depends
            self.outer._add(self.entries, self.facts)
        else:
            self.log.commit(self.base, self.entries, self.facts, self.depends)

    def abort(self) -> None:
        """Delete what was written. A job that is lost never gets here: :meth:`Warehouse.vacuum` finds its files."""
        for table_, folder in {(e.table, e.folder) for e in self.entries if e.folder}:
            self.log.storage.delete(folder if table_ == QUARANTINE else f"{self.root}/{folder}")
        self.entries = []

    def transact(self, work):
        return work(self)

    # One table

    def ledger(self, run_date: str | None = None) -> DataFrame:
        self.depends.add(LEDGER)
        return super().ledger(run_date)

    def _write(self, name: str, rows: DataFrame) -> tuple[str, set[str]]:
        """Write rows with their ``part``; the folder (below the root) and the parts in it."""
        folder = f"{name}/data/g={self.base + 1:09d}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        # Few files per part; adaptive execution splits a part that is large.
        rows.hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.root}/{folder}")
        return folder, {n.removeprefix("part=") for n in self.log.storage.names(f"{self.root}/{folder}") if n.startswith("part=")}

    def replace_parts(self, name: str, rows: DataFrame, parts: set[str], facts: dict | None = None) -> None:
        """``rows`` (with their ``part``) in place of all that ``parts`` of a table had."""
        folder, written = self._write(name, rows)
        self._add([Entry(name, p, folder if p in written else None, True) for p in sorted(parts | written)], {name: facts} if facts else None)

    def add_folder(self, name: str, part: str, folder: str) -> None:
        """Files written elsewhere become part of a table."""
        self._add([Entry(name, part, folder)])

    def _append(self, name: str, schema: T.StructType, rows: DataFrame, part: Column) -> None:
        folder, parts = self._write(name, rows.select(*schema.names, part.alias("part")))
        self._add([Entry(name, p, folder) for p in sorted(parts)])

    def append_quality(self, rows: DataFrame) -> None:
        self._append(QUALITY, QUALITY_LOG_SCHEMA, rows, F.col("run_date").cast("string"))

    def append_alerts(self, rows: DataFrame) -> None:
        self._append(ALERTS, ALERT_SCHEMA, rows, F.col("run_date").cast("string"))

    def record_files(self, outcomes: DataFrame, run_date: str | None = None) -> None:
        """Add entries to the day of the run, or else of the last date in their paths. A day of many small folders becomes one
        again, with the latest entry of each file."""
        day = F.regexp_extract("file_path", _DAY, 1) if run_date is None else F.lit(run_date)
        self._append(LEDGER, LEDGER_SCHEMA, outcomes, F.when(day == "", _WHOLE).otherwise(day))
        many = {p: f for p, f in self.current.folders(LEDGER).items() if len(f) > LEDGER_FOLDERS}
        if many:
            self.depends.add(LEDGER)
            latest = _latest(self._read(LEDGER, LEDGER_SCHEMA, many, generation=True))
            folder, parts = self._write(LEDGER, latest)
            self._add([Entry(LEDGER, p, folder if p in parts else None, True) for p in sorted(many)])

    def upsert(self, name: str, rows: DataFrame, order: tuple[str, ...] = ()) -> int:
        spec = table(name)
        schema, key = spec.warehouse_schema, spec.key
        self.depends.add(spec.warehouse_name)
        folders = self.current.folders(spec.warehouse_name)
        given = rows.select(F.col(key).cast(schema[key].dataType).alias(key)).where(F.col(key).isNotNull())
        known = self.key_parts(name, given)
        touched = {r["at"] for r in known.join(given, key, "left_semi").select("at").distinct().collect()} if folders else set()
        merged_rows = Observation()
        load = last_per_key(rows, key, order) if order else rows.where(F.col(key).isNotNull())
        load = load.observe(merged_rows, F.count(F.lit(1)).alias("rows"))
        current = self._read(spec.warehouse_name, schema, {p: folders[p] for p in touched})
        written = self._publish(spec, merge(current.drop("part"), load, key), touched)
        new = self._read(spec.warehouse_name, schema, {p: [written[0]] for p in written[1]}).select(key, F.col("part").alias("at"))
        if touched:
            new = new.join(given, key, "left_semi").join(known, [key, "at"], "left_anti")
        self._index_rows(spec, new, first=not folders)
        return _seen(merged_rows, written[1])

    def update_where(self, name: str, needed: Column, change: Callable[[DataFrame], DataFrame]) -> None:
        spec = table(name)
        self.depends.add(spec.warehouse_name)
        folders = self.current.folders(spec.warehouse_name)
        rows = self._read(spec.warehouse_name, spec.warehouse_schema, folders)
        touched = {r.part for r in rows.where(needed).select("part").distinct().collect()}
        if not touched:
            return
        current = self._read(spec.warehouse_name, spec.warehouse_schema, {p: folders[p] for p in touched})
        folder, written = self._publish(spec, change(current.drop("part")), touched)
        if moved := written - touched:
            there = self._read(spec.warehouse_name, spec.warehouse_schema, {p: [folder] for p in moved})
            self._index_rows(spec, there.select(spec.key, F.col("part").alias("at")))

    def _publish(self, spec: TableSpec, rows: DataFrame, touched: set[str]) -> tuple[str, set[str]]:
        folder, written = self._write(spec.warehouse_name, rows.select(*spec.warehouse_schema.names, _part_of(spec).alias("part")))
        self._add([Entry(spec.warehouse_name, part, folder if part in written else None, part in touched) for part in sorted(touched | written)])
        return folder, written

    def _index_rows(self, spec: TableSpec, new: DataFrame, first: bool = False) -> None:
        """Add (key, at) rows to the index; join the folders of buckets that have many, double the buckets when they grow large."""
        index, schema, state = _index(spec), self._key_schema(spec), self.current
        if not first and not state.folders(index):  # written before there was an index
            new = self.key_parts(spec.name)
        n, have = self.buckets(spec.name), state.facts.get(index, {}).get("keys", 0)
        counted = Observation()
        added = new.observe(counted, F.count(F.lit(1)).alias("rows")).select(spec.key, "at", _bucket(F.col(spec.key), n).alias("part"))
        folder, parts = self._write(index, added)
        total = have + _seen(counted, parts)
        self._add([Entry(index, p, folder) for p in sorted(parts)], {index: {"buckets": n, "keys": total}})
        folders = self.current.folders(index)
        if total > n * BUCKET_KEYS:
            n = 2 ** math.ceil(math.log2(2 * total / BUCKET_KEYS))
            crowded = folders
        else:
            crowded = {p: f for p, f in folders.items() if len(f) > BUCKET_FOLDERS}
        if not crowded:
            return
        latest = self._read(index, schema, crowded, generation=True).groupBy(spec.key).agg(F.max_by("at", "g").alias("at"))
        folder, parts = self._write(index, latest.select(spec.key, "at", _bucket(F.col(spec.key), n).alias("part")))
        emptied = [Entry(index, p, None, True) for p in sorted(crowded)]
        self._add(emptied + [Entry(index, p, folder) for p in sorted(parts)], {index: {"buckets": n, "keys": total}})


def _index(spec: TableSpec) -> str:
    return f"{spec.warehouse_name}_keys"


def _bucket(key: Column, buckets: int) -> Column:
    return F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), 9, "0")


def _seen(rows: Observation, parts: set[str]) -> int:
    """Rows observed by a write. Where nothing was written the plan may have been cut short, and observed nothing."""
    return rows.get["rows"] if parts else 0


def _latest(entries: DataFrame) -> DataFrame:
    """The latest ledger entry of each file."""
    rest = [c for c in entries.columns if c not in ("file_path", "g")]
    last = F.max_by(F.struct(*rest), F.struct("processed_at", "g")).alias("last")
    return entries.groupBy("file_path").agg(last).select("file_path", "last.*")


def _part_of(spec: TableSpec) -> Column:
    if spec.partition_by is None:
        return F.lit(_WHOLE)
    return F.coalesce(F.date_format(spec.partition_by, "yyyy-MM-dd"), F.lit("none"))
