"""Records of CSV files whose quoted fields span lines, found by many tasks.

Whether a line starts within quotes depends on all lines before it. So each line is first a function of that: it ends
within quotes or not if it starts outside, and if it starts inside. Functions are composed within each block of a file
(for both starts), then over its blocks, of which there are few; then every line knows how it starts, and lines from one
that starts outside to the next are a record.

A quote opens a field only at its start, and ends it only before a comma or the line's end; doubled quotes are part of it, and quotes
elsewhere in a field without quotes are letters. What a quoted field with any other quote in it means, or one that
is never closed, is for the parser to say: such files are told apart (``strange``) and read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_INNER = r'[^"]*+(?:""[^"]*+)*+'
_COMPLETE = rf'(^|,)"{_INNER}"(?=,|$)'
_OPENING = r'(?s)(?:^|,)"(.*)'
_CLOSING, _ANY_END = rf'^{_INNER}"(?=,|$)', rf'^{_INNER}"'

#: How a file is read: line by line, by records found here, or as one value.
LINES, RECORDS, WHOLE = "lines", "records", "whole"


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Lines with their place and what they do: ``f0``, ``f1`` (ends inside if it starts outside, inside), ``odd0``, ``odd1`` (holds a strange quote then)."""
    value = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    start = F.col("_metadata.file_block_start")
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("_file"), start.alias("block"), F.monotonically_increasing_id().alias("n"),
        F.when(start == 0, F.regexp_replace(value, "^\ufeff", "")).otherwise(value).alias("line"))
    rest = lambda text: F.regexp_replace(text, _COMPLETE, "$1")
    odd = lambda text: F.regexp_extract(rest(text), _OPENING, 1).rlike(_ANY_END)
    line, closes = F.col("line"), F.col("line").rlike(_CLOSING)
    after = F.regexp_replace(line, _CLOSING, "")
    quoted = F.contains(line, F.lit('"'))
    return lines.withColumns({
        "f0": quoted & rest(line).rlike(_OPENING),
        "f1": ~quoted | F.when(closes, rest(after).rlike(_OPENING)).otherwise(True),
        "odd0": quoted & odd(line),
        "odd1": quoted & F.when(closes, odd(after)).otherwise(line.rlike(_ANY_END)),
    })


def _starts(over, start: Column) -> Column:
    """Whether a row starts inside: the function of all rows before it in ``over``, applied to ``start``.

    A row either sets the state, whatever it was, or turns it, or leaves it; so the state is that of the last row that sets it, turned by those since.
    """
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    turns, sets = F.col("f0") & ~F.col("f1"), F.col("f0") == F.col("f1")
    turned = lambda frame: F.coalesce(F.count_if(turns).over(frame), F.lit(0)) % 2 == 1
    after_set = F.max(F.when(sets, F.struct("_at", (F.col("f0") != F.col("_turned")).alias("state")))).over(before)["state"]
    return F.coalesce(after_set, start) != turned(before)


def _with_turns(rows: DataFrame, over, at: Column) -> DataFrame:
    """``_turned``: whether rows up to and with this one turn the state an odd number of times; ``_at``: the row's place."""
    turns = F.count_if(F.col("f0") & ~F.col("f1")).over(over.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"_turned": turns % 2 == 1, "_at": at})


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with ``inside`` (where they start), ``ends``, ``odd``, the number of their ``record`` in the file,
    ``header`` (the first that isn't empty) and ``last`` (whether the file ends inside)."""
    in_block = Window.partitionBy("_file", "block").orderBy("n")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    full = F.col("line") != ""
    lines = lines.withColumn("header", full & (F.col("block") == 0) & (F.count_if(full).over(so_far) == 1))
    lines = _with_turns(lines, in_block, F.col("n"))
    lines = lines.withColumns({f"s{k}": _starts(in_block, F.lit(bool(k))) for k in (0, 1)}).drop("_turned", "_at")
    lines = lines.withColumns({f"r{k}": F.count_if(~F.col(f"s{k}")).over(so_far) for k in (0, 1)})
    end = lambda state: F.when(state, F.col("f1")).otherwise(F.col("f0"))
    of_blocks = lines.groupBy("_file", "block").agg(
        *[F.max_by(end(F.col(f"s{k}")), "n").alias(f"f{k}") for k in (0, 1)], *[F.max(f"r{k}").alias(f"r{k}") for k in (0, 1)])
    in_file = Window.partitionBy("_file").orderBy("block")
    blocks = _with_turns(of_blocks, in_file, F.col("block")).withColumn("start", _starts(in_file, F.lit(False)))
    count = F.when(F.col("start"), F.col("r1")).otherwise(F.col("r0"))
    blocks = blocks.select(
        "_file", "block", "start",
        F.coalesce(F.sum(count).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.last(end(F.col("start"))).over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    chosen = lambda name: F.when(F.col("start"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    joined = lines.join(blocks, ["_file", "block"]).withColumn("inside", chosen("s"))
    return joined.select(
        "_file", "block", "n", "line", "header", "inside", end(F.col("inside")).alias("ends"), "last",
        F.when(F.col("inside"), F.col("odd1")).otherwise(F.col("odd0")).alias("odd"), (F.col("base") + chosen("r")).alias("record"))


def layouts(spark: SparkSession, files: list, encoding: str) -> dict[str, str]:
    """How each of the listed ``files`` (by its name) is to be read."""
    if not files:
        return {}
    paths = {f["_file"]: f.path for f in files}
    # A file whose lines all end outside, if they start outside, has no field over several; that takes no look at their order.
    spans = _lines(spark, list(paths.values()), encoding).groupBy("_file").agg(F.bool_or("f0").alias("spans")).collect()
    found = {r["_file"]: LINES for r in spans}
    rest = [paths[r["_file"]] for r in spans if r["spans"]]
    if rest:
        strange = _placed(_lines(spark, rest, encoding)).groupBy("_file").agg(F.bool_or(F.col("odd") | F.col("last")).alias("strange"))
        found |= {r["_file"]: WHOLE if r["strange"] else RECORDS for r in strange.collect()}
    return found


def read_records(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Rows (_file, block, row, record) of files without strange quotes: all records but the first, and empty ones. Lines of one are joined by a newline."""
    placed = _placed(_lines(spark, paths, encoding))
    alone = ~F.col("inside") & ~F.col("ends")
    single = placed.where(alone).select("_file", "block", F.col("n").alias("row"), F.col("line").alias("record"), "header")
    parts = F.array_sort(F.collect_list(F.struct("block", "n", "line")))
    several = placed.where(~alone).groupBy("_file", "record").agg(parts.alias("parts"), F.bool_or("header").alias("header")).select(
        "_file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["n"].alias("row"),
        F.array_join(F.transform("parts", lambda x: x["line"]), "\n").alias("record"), "header")
    return single.unionByName(several).where("not header and record <> ''").drop("header")
