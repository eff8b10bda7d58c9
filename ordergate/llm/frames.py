"""Small helpers of the operators: Arrow maps, scratch tables and connected components."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergate.session import scratch_folder
from ordergate.storage import Storage

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors (once an application), as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        at = Path(tempfile.mkdtemp(prefix="ordergate-"))  # the driver's own: Spark hands the file out
        # texts are long: smaller batches keep Python workers small
        if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        context.addPyFile(shutil.make_archive(str(at / "ordergate"), "zip", root, "ordergate"))
        _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``arrow_map`` by batch; ``fn`` yields dicts of arrays in the order of ``schema``."""

    def run(batches):
        for batch in batches:
            for out in fn(batch):
                yield pa.RecordBatch.from_pydict(out)

    return arrow_map(df, run, schema)


class Scratch:
    """Tables written once to the shared folder, so that work isn't repeated and lineage is cut.

    With ``tidy``, the shuffle files of a table go as soon as it is written: nothing reads them again.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark, self.folder, self.n, self.tidy = spark, scratch_folder(spark, name), 0, tidy
        self.paths: dict[DataFrame, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/t{self.n}"
        if self.tidy:
            before = self.spark.conf.get(_CLEANUP, "false")
            self.spark.conf.set(_CLEANUP, "true")
            try:
                df.write.parquet(path)
            finally:
                self.spark.conf.set(_CLEANUP, before)
        else:
            df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[table] = path
        return table

    def drop(self, table: DataFrame) -> None:
        """Remove a kept table that nothing will read again."""
        Storage(self.spark).delete(self.paths.pop(table))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (id, component), where
    component is the smallest id reachable. Only ids that occur in an edge are returned.

    Each round hooks every vertex to its smallest neighbour, follows the hooks to their
    roots, and contracts the edges; a vertex with a smaller neighbour disappears, so a
    star takes one or two rounds. Hooks are sums over keys, so that a vertex with very
    many links is no single task.
    """
    edges = scratch.keep(edges.select("a", "b").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        hooks = scratch.keep(hooks.select("id", F.least("id", "to").alias("root")))
        while True:
            up = hooks.select(F.col("id").alias("root"), F.col("root").alias("upper"))
            next_ = scratch.keep(hooks.join(up, "root").select("id", F.col("upper").alias("root"), (F.col("upper") != F.col("root")).alias("moved")))
            hooks = next_.select("id", "root")
            if next_.where("moved").isEmpty():
                break
        found = hooks.withColumnRenamed("root", "component") if found is None else scratch.keep(
            found.join(hooks.withColumnRenamed("id", "component"), "component", "left")
            .select("id", F.coalesce("root", "component").alias("component")))
        edges = scratch.keep(
            edges.join(hooks.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a")
            .join(hooks.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return found if found is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
