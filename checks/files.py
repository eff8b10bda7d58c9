"""Writes adapter rows as the CSV and JSON files the readers expect.

Files are cut by key hash so that no file grows with the data, each at most
about ``ROWS_PER_FILE`` rows; brackets, commas and header lines come from a
window over one file's rows. Copies of a key always land in one file. Deliveries
of whole tables are gzipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordergate.registry import TABLES
from ordergate.session import scratch_folder

ROWS_PER_FILE = 50_000


def _file_number(rows: DataFrame, key: str, parts: dict[str, Column]) -> Column:
    """Files are cut within each part: as many as the largest one needs."""
    sizes = rows.groupBy(*[value.alias(name) for name, value in parts.items()]).count()
    largest = sizes.agg(F.max("count")).collect()[0][0] or 0
    files = max(1, -(-largest // ROWS_PER_FILE))
    return F.pmod(F.xxhash64(F.coalesce(F.col(key), F.col("_order").cast("string"))), F.lit(files))


def write_lines(
    rows: DataFrame, folder: str, line: Column, key: str, parts: dict[str, Column],
    before: Column, between: Column, after: Column, options: dict[str, str] | None = None,
) -> None:
    """Text files partitioned by ``parts`` and a file number, lines in ``_order``."""
    numbered = rows.select(
        line.alias("line"), "_order",
        *[value.alias(name) for name, value in parts.items()],
        _file_number(rows, key, parts).alias("n"),
    )
    names = [*parts, "n"]
    in_file = Window.partitionBy(*names).orderBy("_order")
    text = F.concat(
        F.when(F.lag("line").over(in_file).isNull(), before).otherwise(between),
        "line",
        F.when(F.lead("line").over(in_file).isNull(), after).otherwise(""),
    )
    ordered = numbered.withColumn("value", text).sortWithinPartitions(*names, "_order")
    ordered.select("value", *names).write.mode("append").partitionBy(*names).options(**(options or {})).text(folder)


def csv_line(columns: list[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def write_csv(
    rows: DataFrame, folder: str, columns: list[str], key: str, parts: dict[str, Column],
    line: Column | None = None, header: str | None = None, options: dict[str, str] | None = None,
) -> None:
    head = F.lit((header or ",".join(columns)) + "\n")
    write_lines(
        rows, folder, csv_line(columns) if line is None else line, key, parts, head, F.lit(""), F.lit(""), options)


def write_json(
    rows: DataFrame, folder: str, columns: list[str], key: str, parts: dict[str, Column], options: dict[str, str] | None = None,
) -> None:
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    write_lines(rows, folder, line, key, parts, F.lit("["), F.lit(","), F.lit("]"), options)


def write_table(rows: DataFrame, name: str, fmt: str, filename: str, root: str, day: str) -> None:
    """One table of a day: under its slots where the rows have them."""
    columns, key = TABLES[name].column_names, TABLES[name].key
    parts = {"file": F.lit(filename)}
    if "slot" in rows.columns:
        parts = {"slot": F.col("slot"), **parts}
    write = write_json if fmt == "json" else write_csv
    write(rows, f"{root}/{day}", columns, key, parts, options={"compression": "gzip"})


_WRITTEN: dict[tuple, str] = {}


def once(spark: SparkSession, sf_dir: str, what: str, make) -> str:
    """Write an input data set once per session; returns its folder."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _WRITTEN:
        folder = scratch_folder(spark, what)
        make(folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]
