"""Which files are there, what is in them at file level, which are still to do."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordergate.registry import BATCH_FILES, STREAM_FILES
from ordergate.session import local_frame

# Up to this size a file's content is hashed and inspected as one value, which Spark bounds. Larger files are hashed piece
# by piece: CSV files by lines, JSON files by what ends at a closing brace. Only a single such piece must not be larger.
LARGEST_FILE = 2**31 - 1024
# Names of files that Spark's readers decompress. Their hash is that of the bytes as they lie.
COMPRESSED = (".gz", ".bz2", ".deflate")

FILE_COLUMNS = (
    "_file string, path string, length bigint, modified timestamp, table_name string, slot string"
)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return local_frame(spark, [], schema)


def list_files(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """Every file under the folders: listing only, no content is read."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return _empty(spark, "_file string, path string, length bigint, modified timestamp")
    listed = found.select(
        F.col("_metadata.file_path").alias("_file"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )
    # A scan never yields 0-byte files; their names come from the file index.
    # The index spells local paths with three slashes, the scan with one.
    names = [re.sub("^file:/+", "file:/", name) for name in found.inputFiles()]
    names = [(name, unquote(name)) for name in names]
    index = local_frame(spark, names, "_file string, path string")
    return listed.unionByName(index.join(listed, "_file", "left_anti").select(
        "_file", "path", F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modified"),
    ))


def _named(filename: str) -> str:
    """A path segment that is the file, or a folder of its parts ('x=' prefix allowed)."""
    return rf"(?:[^/=]*=)?{re.escape(filename)}(?:/|$)"


def _classify(found: DataFrame, manifest, pattern: str) -> Column:
    table_of = F.lit(None).cast("string")
    for name, filename, _ in reversed(manifest):
        table_of = F.when(found["_file"].rlike(pattern + _named(filename)), name).otherwise(table_of)
    return table_of


def batch_files(spark: SparkSession, batch_dir: str, run_date: str) -> DataFrame:
    """Files of a day's snapshot that the manifest knows, with their table."""
    found = list_files(spark, f"{batch_dir}/{run_date}")
    table_of = _classify(found, BATCH_FILES, f"/{re.escape(run_date)}/")
    return found.select(
        "*", table_of.alias("table_name"), F.lit("").alias("slot")
    ).where("table_name is not null")


def stream_files(spark: SparkSession, stream_dir: str, run_date: str) -> DataFrame:
    """Files of all hourly slots of a day, with their table and slot."""
    found = list_files(spark, f"{stream_dir}/{run_date}")
    day = f"/{re.escape(run_date)}/"
    slot = F.regexp_extract("_file", day + r"(?:[^/=]*=)?([^/]+)/", 1)
    table_of = _classify(found, STREAM_FILES, day + "[^/]+/")
    return found.select(
        "*", table_of.alias("table_name"), slot.alias("slot")
    ).where("table_name is not null")


HEADER_BYTES = 65_536
_BLANK = " \t\n\r\x0b\x0c\ufeff"
FINGERPRINT = "_file string, md5 string, is_utf8 boolean, header string, has_quotes boolean"
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def fingerprint(
    spark: SparkSession, files: DataFrame, as_text: bool = True
) -> DataFrame:
    """Add ``md5, is_utf8, header, has_quotes`` to each file.

    One pass over the bytes answers all file-level questions at once: has the
    content changed, how is it encoded, what is its first line. The last three
    are only asked ``as_text``, which JSON files aren't. The hash of a file beyond ``LARGEST_FILE`` is that of
    its pieces and their places.
    """
    sizes = files.where("length > 0").select("path", "length").collect()
    whole, large = [r.path for r in sizes if r.length <= LARGEST_FILE], [r.path for r in sizes if r.length > LARGEST_FILE]
    packed = [p for p in whole if as_text and p.endswith(COMPRESSED)]
    whole = [p for p in whole if p not in set(packed)]
    facts = _inspect_whole(spark, whole, as_text) if whole else _empty(spark, FINGERPRINT)
    if packed:
        facts = facts.unionByName(_inspect_compressed(spark, packed))
    if large:
        facts = facts.unionByName(_inspect_lines(spark, large) if as_text else _inspect_lines(spark, large, "}").select(
            "_file", "md5", *_not_text()))
    joined = files.join(facts, "_file", "left")
    return joined.withColumn("md5", F.coalesce("md5", F.lit(EMPTY_MD5)))


def _inspect_lines(spark: SparkSession, paths: list[str], end: str = "\n") -> DataFrame:
    """The facts of large files, each read by many tasks in lines, or pieces with another ``end``.

    A line's place is its byte offset: the bytes of the blocks before its own and of the lines before it in its block. So
    the sum over all lines doesn't depend on where the file was split, but on the order of its lines.
    """
    start = F.substring(F.col("value").cast("binary"), 1, HEADER_BYTES)
    lines = spark.read.option("lineSep", end).text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), (F.octet_length("value") + 1).cast("long").alias("size"),
        F.xxhash64("value").bitwiseAND(F.lit(2**31 - 1)).alias("a"), F.shiftrightunsigned(F.xxhash64("value"), 33).alias("b"),
        F.is_valid_utf8("value").alias("utf8"), F.contains("value", F.lit('"')).alias("quoted"),
        # the header is among the first lines of a file, of which the others needn't be carried
        F.when(F.col("_metadata.file_block_start") == 0, F.coalesce(_first_line(start.cast("string")), F.lit(""))).alias("text"),
        F.when(F.col("_metadata.file_block_start") == 0, _first_line(F.decode(start, "ISO-8859-1"))).alias("latin"))
    before = Window.partitionBy("_file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    # In a block only places from its own start are known. The sum of hash * place moves to another start by start * sum of hashes;
    # hashes have 31 bits, so 38 digits hold it exactly for any file.
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    blocks = placed.groupBy("_file", "block").agg(
        F.sum("size").alias("size"), *[F.sum(whole(h)).alias(f"{h}_sum") for h in "ab"], *[F.sum(whole(h) * whole("at")).alias(f"{h}_at") for h in "ab"],
        F.bool_and("utf8").alias("utf8"), F.bool_or("quoted").alias("quoted"), F.min(F.when(F.col("text") != "", F.struct("n", "text", "latin"))).alias("first"))
    earlier = Window.partitionBy("_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = blocks.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)).cast("decimal(17,0)"))
    moved = [F.sum(F.col(f"{h}_at") + F.col("start") * F.col(f"{h}_sum").cast("decimal(20,0)")).cast("string") for h in "ab"]
    facts = started.groupBy("_file").agg(
        F.md5(F.concat_ws(",", *moved, F.sum("size").cast("string"))).alias("md5"), F.bool_and("utf8").alias("is_utf8"),
        F.max(F.when(F.col("block") == 0, F.col("first"))).alias("first"), F.bool_or("quoted").alias("has_quotes"))
    header = F.when(F.col("is_utf8"), F.col("first.text")).otherwise(F.col("first.latin")).alias("header")
    return facts.select("_file", "md5", "is_utf8", header, "has_quotes")


def _first_line(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, "^[\ufeff\\s]*([^\r\n]+)", 1), F.lit(""))


def _not_text() -> list[Column]:
    return [F.lit(True).alias("is_utf8"), F.lit(None).cast("string").alias("header"), F.lit(False).alias("has_quotes")]


def _inspect_whole(spark: SparkSession, paths: list[str], as_text: bool) -> DataFrame:
    content = spark.read.format("binaryFile").load(paths)
    name, md5 = F.col("_metadata.file_path").alias("_file"), F.md5("content").alias("md5")
    if not as_text:
        return content.select(name, md5, *_not_text())
    text = F.col("content").cast("string")
    utf8 = F.is_valid_utf8(text)
    readable = F.when(utf8, text).otherwise(F.decode("content", "ISO-8859-1"))
    return content.select(
        name, md5, utf8.alias("is_utf8"), _first_line(readable).alias("header"),
        F.contains(readable, F.lit('"')).alias("has_quotes"))


def _inspect_compressed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The facts of compressed text files: the hash by their bytes, the rest by the lines in them."""
    hashes = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("_file"), F.md5("content").alias("md5"))
    value = F.col("value")
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("n"), F.is_valid_utf8(value).alias("utf8"),
        F.contains(value, F.lit('"')).alias("quoted"), F.when(F.trim(value, F.lit(_BLANK)) != "", F.substring(value.cast("binary"), 1, HEADER_BYTES)).alias("text"))
    facts = lines.groupBy("_file").agg(
        F.bool_and("utf8").alias("is_utf8"), F.bool_or("quoted").alias("has_quotes"),
        F.min_by("text", F.when(F.col("text").isNotNull(), F.col("n"))).alias("first"))
    header = F.when(F.col("is_utf8"), _first_line(F.col("first").cast("string"))).otherwise(_first_line(F.decode("first", "ISO-8859-1"))).alias("header")
    return hashes.join(facts, "_file", "left").select(
        "_file", "md5", F.coalesce("is_utf8", F.lit(True)).alias("is_utf8"), header, F.coalesce("has_quotes", F.lit(False)).alias("has_quotes"))


def pending(files: DataFrame, ledger: DataFrame, terminal: Iterable[str] = ("success",)) -> DataFrame:
    """Fingerprinted files not yet recorded under this content with a terminal status."""
    done = ledger.where(F.col("status").isin(*terminal)).select(
        F.col("file_path").alias("_file"), F.col("md5_hash").alias("md5"))
    return files.join(done, ["_file", "md5"], "left_anti")
