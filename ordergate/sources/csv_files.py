"""CSV with header, read as text, by column name, tolerant of bad lines.

Lines with too many fields are skipped, lines with too few are padded with
NULL. Files whose header lacks a required column are reported, not read. A
file that is not valid UTF-8 is read as ISO-8859-1.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.functions.coerce import csv_missing_to_null
from ordergate.registry import TableSpec
from ordergate.session import local_frame
from ordergate.sources import csv_records

_RAW, _EXTRA = "_raw_line", "_extra_field"


def missing_columns(header: str | None, spec: TableSpec) -> list[str]:
    names = set(split_header(header))
    return [c for c in spec.column_names if c not in names]


def split_header(header: str | None) -> list[str]:
    return next(csv.reader([header]), []) if header else []


def _positional_schema(names: list[str], spec: TableSpec) -> tuple[T.StructType, list[str]]:
    """Columns by position. Names outside the registry, and repeats, get a stand-in."""
    fields, seen = [], set()
    for i, name in enumerate(names):
        known = name in spec.by_name and name not in seen
        seen.add(name)
        fields.append(name if known else f"_unused_{i}")
    columns = [T.StructField(n, T.StringType()) for n in [*fields, _EXTRA, _RAW]]
    return T.StructType(columns), fields


def _too_many_fields(width: int) -> Column:
    """True for a line longer than the header.

    The schema is one field wider than the header. A line of exactly that width
    parses cleanly (no raw line kept); a longer one shows text in the extra
    field, or, when that field is empty, by its delimiters outside quotes.
    """
    commas = lambda c: F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    raw = F.col(_RAW)
    unquoted = F.regexp_replace(raw, '"(?:[^"]|"")*"', "")
    return (
        raw.isNull()
        | F.col(_EXTRA).isNotNull()
        | F.when(commas(raw) >= width, commas(unquoted) >= width).otherwise(False)
    )


def _read_group(
    spark: SparkSession, paths: list[str], names: list[str], encoding: str, layout: str,
    spec: TableSpec,
) -> DataFrame:
    schema, fields = _positional_schema(names, spec)
    if layout == csv_records.RECORDS:
        records = csv_records.read_records(spark, paths, encoding)
        types = ", ".join(f"`{f.name}` string" for f in schema.fields)
        parsed = F.from_csv("record", types, {"escape": '"', "columnNameOfCorruptRecord": _RAW})
        rows = records.select("_file", "block", "row", F.inline(F.array(parsed)))
        order = F.struct("block", "row").alias("_order")
    else:
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("encoding", encoding)
            .option("escape", '"')
            .option("multiLine", layout == csv_records.WHOLE)
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _RAW)
            .csv(paths)
        ).withColumn("_file", F.col("_metadata.file_path"))
        order = F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_order")
    lineage = rows.select("_file", order, *[F.col(f) for f in fields if not f.startswith("_unused_")], _EXTRA, _RAW)
    kept = lineage.where(~_too_many_fields(len(names)))
    return kept.select(
        "_file", "_order",
        *[
            (csv_missing_to_null(F.col(c)) if c in fields else F.lit(None).cast("string")).alias(c)
            for c in spec.column_names
        ],
    )


def read_csv(spark: SparkSession, files: list, spec: TableSpec, check_columns: bool = True) -> DataFrame:
    """Rows of many files as text columns with ``_file`` and ``_order``.

    ``files`` are fingerprinted file rows (path, header, is_utf8, has_quotes).
    Files that share header, encoding and layout are one scan. Splits of a file are parallel, also where
    quoted fields span lines, but for files with quotes that only the parser can tell apart.
    """
    by_encoding, headers = defaultdict(list), {}
    for f in files:
        names = tuple(split_header(f.header))
        if not names or (check_columns and missing_columns(f.header, spec)):
            continue
        headers[f["_file"]] = names
        by_encoding["UTF-8" if f.is_utf8 else "ISO-8859-1"].append(f)
    groups = defaultdict(list)
    for encoding, some in by_encoding.items():
        layouts = csv_records.layouts(spark, [f for f in some if f.has_quotes], encoding)
        for f in some:
            groups[headers[f["_file"]], encoding, layouts.get(f["_file"], csv_records.LINES)].append(f.path)
    scans = [
        _read_group(spark, paths, list(names), encoding, layout, spec)
        for (names, encoding, layout), paths in sorted(groups.items())
    ]
    if not scans:
        fields = ", ".join(f"{c} string" for c in spec.column_names)
        return local_frame(
            spark, [], f"_file string, _order struct<block: bigint, row: bigint>, {fields}")
    return reduce(DataFrame.unionByName, scans)
