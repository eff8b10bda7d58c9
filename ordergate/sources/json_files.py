"""JSON files holding an array of flat objects, read as text columns.

A bare object counts as one row. A file that is malformed, a scalar, or lacks a
required column gives a single row with ``_error`` set, so one bad file never
stops the others.

Files are read member by member, whatever their size, each registered column as a
variant: there an absent key is NULL and a JSON null is not. A first pass finds
for each file whether it can be read and which columns no member has; the
second reads the rows of the good ones. Files of up to ``SPLIT_FROM`` bytes are one task each,
larger ones are read by as many as they have splits.

Whoever stores the rows needs one pass only: :func:`read_json_unchecked` gives rows with ``_seen``, from which
the stored rows tell the same of each file. Rows of bad files are then to be left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.registry import TableSpec
from ordergate.session import local_frame
from ordergate.sources import json_records

# A file that Spark would read in one split anyway gains nothing from finding its members first.
SPLIT_FROM = 2**27
# Marks the one row that stands for a file holding an empty array.
EMPTY_LIST = ""
#: Bits of a row: one for each column it has (null or not), the next one if it stands for what could not be read.
SEEN = "_seen"


def _members(spark: SparkSession, paths: list[str], spec: TableSpec) -> DataFrame:
    fields = [T.StructField(c, T.VariantType()) for c in spec.column_names]
    rows = (
        spark.read.schema(T.StructType([*fields, T.StructField("_bad", T.StringType())]))
        .option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(paths)
    )
    return rows.select(
        F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"), *spec.column_names, "_bad")


def _without_rows(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The error of files in which no member was found: an empty array is none."""
    if not paths:
        return {}
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("_file"), "value")
    lists = lines.groupBy("_file").agg(F.bool_or(F.contains("value", F.lit("["))).alias("is_list"))
    return {r["_file"]: EMPTY_LIST for r in lists.collect() if r["is_list"]}


def _file_errors(spark: SparkSession, files: list, spec: TableSpec) -> dict[str, str]:
    """Files that give no rows, and why: names and reasons only."""
    seen = _members(spark, [f.path for f in files], spec).groupBy("_file").agg(F.bit_or(_seen(spec)).alias(SEEN)).collect()
    return _errors_of(spark, files, spec, {r["_file"]: r[SEEN] for r in seen})


def _seen(spec: TableSpec) -> Column:
    bits = [F.when(F.col(c).isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate((*spec.column_names, "_bad"))]
    return reduce(Column.bitwiseOR, bits)


def _errors_of(spark: SparkSession, files: list, spec: TableSpec, seen: dict[str, int]) -> dict[str, str]:
    """The errors of files whose rows have these ``SEEN`` bits; a file without rows has none."""
    names = spec.column_names
    errors = {}
    for file in (f["_file"] for f in files if f["_file"] in seen):
        absent = [c for k, c in enumerate(names) if not seen[file] >> k & 1]
        if seen[file] >> len(names) & 1:
            errors[file] = "Malformed JSON"
        elif absent:
            errors[file] = f"Missing required columns: {', '.join(absent)}"
    return errors | _without_rows(spark, [f.path for f in files if f["_file"] not in seen])


_BEFORE = r"^(\ufeff?[\s\[,]*)"
# What may stand before a member: the array's start, a comma, nothing (a bare object).
_KINDS = {"start": r"^\ufeff?\s*\[\s*$", "next": r"^\s*,\s*$", "bare": r"^\ufeff?\s*$"}


def _split_members(spark: SparkSession, paths: list[str], spec: TableSpec) -> DataFrame:
    """Members of large files: ``_file``, their place, what is before them (``_kind``), and the columns as variants; what is no member has no ``_kind`` but a ``_rest``."""
    found = json_records.members(spark, paths)
    kind = F.coalesce(*[F.when(F.regexp_extract("value", _BEFORE, 1).rlike(p), F.lit(k)) for k, p in _KINDS.items()], F.lit("bad"))
    types = ", ".join([*(f"`{c}` variant" for c in spec.column_names), "_bad string"])
    parsed = F.from_json(F.regexp_replace("value", _BEFORE, ""), types, {"columnNameOfCorruptRecord": "_bad"})
    rows = found.select(
        "_file", "block", "row", F.when(F.col("closed"), kind).alias("_kind"), F.when(~F.col("closed"), F.col("value")).alias("_rest"),
        F.when(F.col("closed"), parsed).alias("_parsed"))
    return rows.select("_file", "block", "row", "_kind", "_rest", F.inline_outer(F.array("_parsed")))


def _split_errors(spark: SparkSession, files: list, spec: TableSpec) -> dict[str, str]:
    """:func:`_file_errors` of large files."""
    if not files:
        return {}
    names, member = spec.column_names, F.col("_kind").isNotNull()
    of_kind = lambda k: F.count_if(F.col("_kind") == k)
    facts = _split_members(spark, [f.path for f in files], spec).groupBy("_file").agg(
        F.count_if(member).alias("_members"), *[of_kind(k).alias(f"_{k}") for k in ("start", "next", "bare")],
        F.min_by("_kind", F.when(member, F.struct("block", "row"))).alias("_first"), F.bool_or(member & F.col("_bad").isNotNull()).alias("_broken"),
        F.count("_rest").alias("_rests"), F.coalesce(F.max(F.substring("_rest", 1, 1000)), F.lit("")).alias("_rest"), *[F.bool_and(F.col(c).isNull()).alias(c) for c in names])
    # What is left over is a closing bracket, or a whole file without members.
    rest = F.when(F.col("_rests") <= 1, F.col("_rest")).otherwise("broken")
    facts = facts.withColumns({
        "_list": (F.col("_first") == "start") & (F.col("_start") == 1) & (F.col("_next") == F.col("_members") - 1) & rest.rlike(r"^\s*\]\s*$"),
        "_object": (F.col("_first") == "bare") & (F.col("_members") == 1) & rest.rlike(r"^\s*$"),
        "_none": (F.col("_members") == 0) & rest.rlike(r"^\ufeff?\s*\[\s*\]\s*$")})
    errors = {}
    for r in facts.select("_file", "_list", "_object", "_none", "_broken", *names).collect():
        absent = [c for c in names if r[c]]
        if r["_none"]:
            errors[r["_file"]] = EMPTY_LIST
        elif r["_broken"] or not (r["_list"] or r["_object"]):
            errors[r["_file"]] = "Malformed JSON"
        elif absent:
            errors[r["_file"]] = f"Missing required columns: {', '.join(absent)}"
    return errors


def _by_size(files: list, split_from: int | None) -> tuple[list, list]:
    """Large files, which are split, and small ones; none without content."""
    limit = SPLIT_FROM if split_from is None else split_from
    files = [f for f in files if f.length > 0]
    return [f for f in files if f.length > limit], [f for f in files if f.length <= limit]


def read_json(spark: SparkSession, files: list, spec: TableSpec, split_from: int | None = None) -> DataFrame:
    """Rows of many files with ``_file``, ``_order`` and ``_error``.

    ``files`` are listed file rows (path, length); those above ``split_from`` bytes (``SPLIT_FROM``) are split.
    """
    large, small = _by_size(files, split_from)
    errors = (_file_errors(spark, small, spec) if small else {}) | _split_errors(spark, large, spec)
    return _rows(spark, large, small, spec, errors)


def read_json_unchecked(
    spark: SparkSession, files: list, spec: TableSpec, split_from: int | None = None
) -> tuple[DataFrame, Callable[[dict[str, int]], dict[str, str]]]:
    """The rows of :func:`read_json` with ``_seen``, as if all small files were good; and the errors of these by the bits of their rows, collected by file."""
    large, small = _by_size(files, split_from)
    rows = _rows(spark, large, small, spec, _split_errors(spark, large, spec), seen=True)
    return rows, lambda seen: _errors_of(spark, small, spec, seen)


def _rows(spark: SparkSession, large: list, small: list, spec: TableSpec, errors: dict[str, str], seen: bool = False) -> DataFrame:
    """Rows of the files that have no error, and one for each that has."""
    names, more = spec.column_names, [SEEN] if seen else []
    columns = ", ".join(f"{c} string" for c in names)
    rows = local_frame(
        spark, [(file, {"block": 0, "row": 0}, *[None] * len(names), error) for file, error in errors.items()],
        f"_file string, _order struct<block: bigint, row: bigint>, {columns}, _error string")
    if seen:
        rows = rows.withColumn(SEEN, F.lit(0).cast("bigint"))
    good, split = ([f.path for f in some if f["_file"] not in errors] for some in (small, large))
    if good:
        members = _members(spark, good, spec)
        rows = rows.unionByName(_as_text(members, _order(F.col("_row")), names, [_seen(spec).alias(c) for c in more]))
    if split:
        members = _split_members(spark, split, spec).where("_kind is not null")
        rows = rows.unionByName(_as_text(members, F.struct("block", "row").alias("_order"), names, [F.lit(0).cast("bigint").alias(c) for c in more]))
    return rows


def _as_text(members: DataFrame, order: Column, names: list[str], more: list[Column]) -> DataFrame:
    return members.select("_file", order, *[_text(F.col(c)).alias(c) for c in names], F.lit(None).cast("string").alias("_error"), *more)


def _order(row: Column) -> Column:
    """A file is read by one task, so the row number alone orders it."""
    return F.struct(F.lit(0).cast("bigint").alias("block"), row.cast("bigint").alias("row")).alias("_order")


def _text(member: Column) -> Column:
    """A member as text. The literal NaN is how some writers spell a missing value."""
    text = F.try_variant_get(member, "$", "string")
    return F.when(text != "NaN", text)
