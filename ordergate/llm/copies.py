"""Exact duplicates by a heavy-hitter split.

Texts are equal if they are identical after lower-casing A-Z only. Of equal texts the row with the largest id stays.

1. Every row becomes (row number, id, SHA-256 of the normalised text), written once; texts go no further.
2. *Misra-Gries.* Each task sums its digests into at most ``COUNTERS`` counters: when there are more, the largest of those that
   must go is taken off all of them. What is taken off in a task is less than its rows / ``COUNTERS``, so the summed counters of all tasks
   are at most rows / ``COUNTERS`` too small, and never too large.
3. *Winners.* A digest of at least rows / ``HEAVY`` rows has a sum of at least rows / ``HEAVY`` - rows / ``COUNTERS``; as the sums
   add up to no more than the rows, fewer than ``HEAVY * COUNTERS / (COUNTERS - HEAVY)`` digests reach that (1366 with the defaults).
   These are broadcast to count their rows and find their largest id exactly, and those results are broadcast to label
   their rows where they lie, without a shuffle.
4. The rows of all other digests are shuffled by digest. None of these has more than rows / ``HEAVY`` rows.

Edge cases: a null text is empty, and empty texts are equal. A null id counts as smaller than any other; a group of null ids only has a null
``keep_id``, and one of its rows stays. Rows with one id and equal texts are told apart by row number: one of them stays. Ids that occur with
several texts are in several groups. An empty table gives no rows. Long texts are hashed whole. Other columns are ignored unless ``carry`` names
them; a carried column may have any name but those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map

#: Counters of a task, and the share of all rows (one in so many) that makes a digest heavy.
COUNTERS, HEAVY = 4096, 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; null is empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # of ASCII texts ``lower`` changes nothing else, and is faster
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def _reduced(counts: pa.Table, counters: int) -> pa.Table:
    """At most ``counters`` of the counters, less the largest of the others."""
    if len(counts) <= counters:
        return counts
    n = counts["n"].to_numpy()
    n = n - np.partition(n, len(n) - counters - 1)[len(n) - counters - 1]
    return pa.table({"digest": counts["digest"], "n": n}).filter(pa.array(n > 0))


def frequent(batches: Iterator[pa.RecordBatch], counters: int) -> pa.Table:
    """Misra-Gries counters (digest, n) of a column of digests."""
    held = pa.table({"digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    for batch in batches:
        seen = pc.value_counts(batch.column(0).cast(pa.binary()))
        new = pa.table({"digest": seen.field("values"), "n": seen.field("counts")})
        summed = pa.concat_tables([held, new]).group_by("digest", use_threads=False).aggregate([("n", "sum")])
        held = _reduced(pa.table({"digest": summed["digest"].combine_chunks(), "n": summed["n_sum"].combine_chunks()}), counters)
    return held


def heavy_digests(digests: DataFrame, n_rows: int, counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """Rows (digest) of every digest that ``n_rows / heavy`` rows or more have, and of fewer than heavy * counters / (counters - heavy) in all."""

    def run(batches):
        yield from frequent(batches, counters).to_batches()

    sums = arrow_map(digests.select("digest"), run, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    # n >= rows / heavy - rows / counters, in whole numbers; a digest met once needs no split
    return sums.where((F.col("n") * (heavy * counters) >= F.lit(n_rows * (counters - heavy))) & (F.col("n") > 1)).select("digest")


def exact_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", carry: Sequence[str] = (),
                     counters: int = COUNTERS, heavy: int = HEAVY) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256) and the ``carry`` columns."""
    scratch = Scratch(docs.sparkSession, "copies")
    rows = scratch.keep(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_).cast("long").alias("id"),
        F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)).alias("digest"), F.struct(F.lit(0).alias("none"), *carry).alias("carried")))
    candidates = scratch.keep(heavy_digests(rows, rows.count(), counters, heavy))
    last = F.max(F.struct("id", "row"))
    # both broadcasts hold fewer rows than the bound of ``heavy_digests``
    winners = rows.select("digest", "id", "row").join(F.broadcast(candidates), "digest").groupBy("digest").agg(last.alias("last"), F.count("*").alias("n"))
    winners = scratch.keep(winners.where("n > 1"))
    frequent_ = rows.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    others = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").withColumns({"last": last.over(same), "n": F.count("*").over(same)})
    return frequent_.unionByName(others).select(
        F.col("id").alias("doc_id"), F.col("last.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), *[F.col("carried")[c].alias(c) for c in carry])


def without_copies(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns."""
    at = {f"c{i}": c for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in at.items()])
    key = {c: k for k, c in at.items()}
    kept = exact_duplicates(renamed, key[id_], key[text], carry=list(at)).where("kept")
    return kept.select(*[F.col(k).alias(c) for k, c in at.items()])
