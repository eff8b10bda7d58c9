"""The daily snapshot job: thirteen tables, lookups before entities."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergate.operators.metrics import FAILED
from ordergate.operators.references import declared_checks, warehouse_keys
from ordergate.plans.table_job import STATUS_COLUMNS, Run, TableResult, at_once, record, run_table_apart
from ordergate.registry import BATCH_FILES, TABLES, declared_references
from ordergate.session import local_frame
from ordergate.sources.files import batch_files
from ordergate.sources.ledger import ledger_rows

ALREADY = "already_processed"


def _without_work(run: Run, found: DataFrame, touched: DataFrame, batch_dir: str) -> DataFrame:
    """Manifest entries that had nothing to do: loaded before, or not delivered."""
    done = found.join(touched.select("_file"), "_file", "left_anti").select(
        "table_name", "slot", "_file", F.lit(ALREADY).alias("status"))
    manifest = local_frame(
        run.spark, [(t, f"{batch_dir}/{run.run_date}/{f}") for t, f, _ in BATCH_FILES], "table_name string, _file string")
    absent = manifest.join(found.select("table_name").distinct(), "table_name", "left_anti").select(
        "table_name", F.lit("").alias("slot"), "_file", F.lit(FAILED).alias("status"),
        F.concat(F.lit("File not found: "), "_file").alias("error"))
    return done.unionByName(absent, allowMissingColumns=True)


def _waves(names: list[str]) -> list[list[str]]:
    """Tables grouped so that each one's parents are in an earlier group."""
    waves: list[list[str]] = []
    placed: set[str] = set()
    while len(placed) < len(names):
        ready = [
            n for n in names if n not in placed
            and all(p in placed or p not in names for _, p, _ in declared_references(TABLES[n]))
        ]
        waves.append(ready)
        placed.update(ready)
    return waves


def run_batch(
    run: Run, batch_dir: str, tables: list[str] | None = None, parallel: int = 4
) -> DataFrame:
    """Load a day's snapshot; returns one status row per file.

    Tables that do not refer to each other are submitted side by side, and all of them
    become visible by one commit. ``tables`` limits the run to some tables of the manifest.
    """
    return at_once(run, lambda inside: _run_batch(inside, batch_dir, tables, parallel))


def _run_batch(run: Run, batch_dir: str, tables: list[str] | None, parallel: int) -> DataFrame:
    formats = {name: fmt for name, _, fmt in BATCH_FILES if tables is None or name in tables}
    found = batch_files(run.spark, batch_dir, run.run_date).where(F.col("table_name").isin(*formats))

    def load(name: str) -> TableResult | None:
        spec = TABLES[name]
        parents = {parent: warehouse_keys(run.warehouse, parent) for _, parent, _ in declared_references(spec)}
        return run_table_apart(run, found, spec, formats[name], declared=declared_checks(spec, parents))

    statuses = []
    with ThreadPoolExecutor(parallel) as pool:
        for wave in _waves(list(formats)):
            results = [r for r in pool.map(load, wave) if r is not None]
            record(run, results)
            statuses += [r.status for r in results]
    nothing = local_frame(run.spark, [], STATUS_COLUMNS)
    worked = reduce(DataFrame.unionByName, statuses, nothing)
    idle = _fill(_without_work(run, found, worked, batch_dir).where(F.col("table_name").isin(*formats)))
    absent = idle.where(F.col("status") == FAILED)
    if not absent.isEmpty():
        run.warehouse.record_files(ledger_rows(absent, run.run_timestamp), run.run_date)
    return worked.unionByName(idle)


def _fill(idle: DataFrame) -> DataFrame:
    have = set(idle.columns)
    columns = [c.strip().split(" ") for c in STATUS_COLUMNS.split(",")]
    return idle.select(*[
        (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in columns
    ])
