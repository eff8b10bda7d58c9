"""Members of large JSON arrays, found by many tasks.

A file is read in pieces that end at each closing brace. Whether a piece starts within a string depends on the quotes before it,
and whether its brace closes a member on the braces before it outside of strings. Both are sums: of quotes, and then of braces
for either start of a block. They are added up within each block of a file and then over its blocks, of which there are
few. Most pieces are one member; only pieces of members with braces in strings or nested values are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _count(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pieces with their place, ``turns`` (an odd number of quotes) and the braces they open if they start outside (``o0``) or inside (``o1``) a string."""
    read = spark.read.option("lineSep", "}").text(paths)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = lambda text: F.regexp_replace(text, '"[^"]*+(?:"|$)', "")
    return read.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("piece"),
        (_count(plain, '"') % 2 == 1).alias("turns"), _count(outside(plain), "{").alias("o0"),
        _count(outside(F.regexp_replace(plain, '^[^"]*+(?:"|$)', "")), "{").alias("o1"))


def members(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows (_file, block, row, value, closed): each member with what is before it in the file, in order of (block, row). What follows the last one, or
    all of a file without any, is a row that isn't ``closed``; so is the end of a broken file."""
    in_block = Window.partitionBy("_file", "block").orderBy("n")
    before, so_far = in_block.rowsBetween(Window.unboundedPreceding, -1), in_block.rowsBetween(Window.unboundedPreceding, 0)
    odd = lambda frame: F.coalesce(F.count_if("turns").over(frame), F.lit(0)) % 2 == 1
    pieces = _pieces(spark, paths).withColumn("s", odd(before))
    # Braces a piece opens, less its own where that is outside a string, for a block that starts outside (0) or inside (1).
    opened = {k: F.when(F.col("s") != F.lit(bool(k)), F.col("o1")).otherwise(F.col("o0")) for k in (0, 1)}
    closes = {k: ((F.col("s") != F.col("turns")) == F.lit(bool(k))).cast("int") for k in (0, 1)}
    pieces = pieces.withColumns({f"d{k}": opened[k] - closes[k] for k in (0, 1)})
    pieces = pieces.withColumns({f"e{k}": F.sum(f"d{k}").over(so_far) for k in (0, 1)})
    of_blocks = pieces.groupBy("_file", "block").agg(
        (F.count_if("turns") % 2 == 1).alias("turns"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"),
        F.sum(F.octet_length("piece").cast("long") + 1).alias("bytes"), F.max("n").alias("final"), F.max("size").alias("size"))
    in_file = Window.partitionBy("_file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = of_blocks.withColumn("start", odd(earlier))
    chosen = lambda name: F.when(F.col("start"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    all_blocks = Window.partitionBy("_file")
    # The last piece of a file is followed by no brace, unless the file ends with one.
    open_end = F.sum("bytes").over(all_blocks) > F.col("size")
    # A file that ends within a string or a member isn't put together: only its last piece is returned.
    broken = (F.count_if("turns").over(all_blocks) % 2 == 1) | (F.sum(chosen("d")).over(all_blocks) + open_end.cast("int") != 0)
    final = F.when(F.col("block") == F.max("block").over(all_blocks), F.col("final"))
    blocks = blocks.select(
        "_file", "block", "start", F.coalesce(F.sum(chosen("d")).over(earlier), F.lit(0)).alias("base"),
        F.when(open_end | broken, final).alias("tail"), broken.alias("broken"))
    placed = pieces.join(blocks, ["_file", "block"]).where("not broken or n = tail")
    tail = F.coalesce(F.col("n") == F.col("tail"), F.lit(False))
    inside_after = (F.col("s") != F.col("start")) != F.col("turns")
    placed = placed.withColumns({
        "closed": ~tail & ~inside_after & (F.col("base") + chosen("e") == 0),
        "alone": F.col("base") + chosen("e") - chosen("d") == 0, "from_outside": F.col("s") == F.col("start")})
    value = F.when(tail, F.col("piece")).otherwise(F.concat("piece", F.lit("}")))
    placed = placed.select("_file", "block", "n", value.alias("value"), "closed", (F.col("alone") & F.col("from_outside")).alias("opens"))
    whole = F.col("closed") & F.col("opens")
    single = placed.where(whole).select("_file", "block", F.col("n").alias("row"), "value", "closed")
    # The others are numbered by the members that begin among them.
    rest = placed.where(~whole)
    begun = rest.groupBy("_file", "block").agg(F.count_if("opens").alias("begun")).select(
        "_file", "block", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("begun"))
    numbered = rest.join(begun, ["_file", "block"]).withColumn("member", F.col("begun") + F.count_if("opens").over(so_far))
    parts = F.array_sort(F.collect_list(F.struct("block", "n", "value", "closed")))
    several = numbered.groupBy("_file", "member").agg(parts.alias("parts")).select(
        "_file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["n"].alias("row"),
        F.array_join(F.transform("parts", lambda x: x["value"]), "").alias("value"), F.element_at("parts", -1)["closed"].alias("closed"))
    return single.unionByName(several)
