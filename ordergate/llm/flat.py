"""Token counts of documents in flat, unindexed token files.

A flat file is one run of little-endian ids; each document ends with a separator id. Files
are read as blocks (file, block, payload); documents reach over blocks. Each block
is searched for separators in one vectorised comparison and becomes one summary row. A prefix scan over the summaries of
a file says for each block how many tokens lie before it and where the document that is open at its start began; it has two
levels, so that a single huge file isn't one task's. Then the counts of all documents follow.

Edge cases: two separators in a row are an empty document (0 tokens); tokens after the last separator of a file are an
open document (``closed`` false), unless there are none; empty files and blocks give nothing; null payloads are empty. A payload
must hold whole ids. Blocks may repeat only if they are other files' blocks. The separator must be an id that no text is encoded to
(``SEPARATOR`` lies above the vocabulary); ``flat_blocks`` refuses a text that holds it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map
from ordergate.llm.tokens import portions, word_pieces

BLOCK_BYTES = 1 << 20
LEVEL = 1024
#: The largest 16-bit id. The id of ``<|endoftext|>`` won't do: a text may hold these letters.
SEPARATOR = 0xFFFF


def flat_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the binary files under ``path`` (each of at most 2 GB, which Spark reads whole)."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    cut = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("length") / block_bytes) - 1)))
    return cut.select(F.col("path").alias("file"), "block", F.substring("content", (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("payload"))


def flat_blocks(docs: DataFrame, tokenizer: str, separator: int, block_bytes: int = BLOCK_BYTES, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` as flat 16-bit token files, one a partition, in blocks: (file, block, payload, ended), where ``ended``
    has the ids of the documents whose separator lies in the block, in order."""

    def run(batches):
        encoder, file, block, held, size, ended = word_pieces(tokenizer), TaskContext.get().partitionId(), 0, [], 0, []
        mark = np.array([separator], "<u2").tobytes()

        def row(payload, ids):
            return pa.RecordBatch.from_pydict({"file": pa.array([str(file)]), "block": pa.array([block], pa.int64()),
                                               "payload": pa.array([payload], pa.binary()), "ended": pa.array([ids], pa.list_(pa.int64()))})

        for batch in batches:
            for low, high in portions(batch.column(1)):
                part = batch.slice(low, high - low)
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids = np.frombuffer(ids, "<u4")
                    if (ids == separator).any() or (ids > 0xFFFF).any():
                        raise ValueError(f"document {doc} has a token that is the separator {separator} or wider than 16 bits")
                    held.append(ids.astype("<u2").tobytes() + mark)
                    size += len(held[-1])
                    while size > block_bytes:  # the document's separator lies beyond the cut
                        whole = b"".join(held)
                        yield row(whole[:block_bytes], ended)
                        held, size, block, ended = [whole[block_bytes:]], size - block_bytes, block + 1, []
                    ended.append(doc)
        if size:
            yield row(b"".join(held), ended)

    return arrow_map(docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "file string, block long, payload binary, ended array<long>")


def _summaries(blocks: DataFrame, separator: int, width: int) -> DataFrame:
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            out = []
            for payload in batch.column(names.index("payload")).to_pylist():
                ids = np.frombuffer(payload or b"", kind)
                out.append((len(ids), np.flatnonzero(ids == separator)))
            ended = batch.column(names.index("ended")) if "ended" in names else pa.nulls(len(batch), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("file")), batch.column(names.index("block")), pa.array([n for n, _ in out], pa.int64()),
                 pa.array([p for _, p in out], pa.list_(pa.int64())), ended], names=["file", "block", "n", "ends", "ended"])

    return arrow_map(blocks, run, "file string, block long, n long, ends array<long>, ended array<long>")


def token_counts(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """Rows (file, start, n_tokens, closed, doc_id) of every document: its place in its file, its tokens without the separator, and
    the id that ``ended`` gives for it (null without such a column)."""
    # kept, as it is read several times: one small row per block
    rows = Scratch(blocks.sparkSession, "flat").keep(_summaries(blocks, separator, width)).withColumns({"part": F.floor(F.col("block") / LEVEL), "last": F.element_at("ends", -1) + 1})
    rows = rows.withColumn("last", F.when(F.size("ends") > 0, F.col("last")))
    inner = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    rows = rows.withColumn("open", F.max(F.col("before") + F.col("last")).over(inner))
    parts = rows.groupBy("file", "part").agg(F.sum("n").alias("part_n"), F.max(F.col("before") + F.col("last")).alias("part_last"))
    outer = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_before", F.coalesce(F.sum("part_n").over(outer), F.lit(0)))
    parts = parts.withColumn("part_open", F.coalesce(F.max(F.col("part_before") + F.col("part_last")).over(outer), F.lit(0)))
    last = parts.groupBy("file").agg(F.max(F.col("part_before") + F.col("part_n")).alias("all"), F.max(F.col("part_before") + F.col("part_last")).alias("closed_at"))
    at = rows.join(parts.select("file", "part", "part_before", "part_open"), ["file", "part"])
    at = at.withColumn("from", F.coalesce(F.col("part_before") + F.col("open"), F.col("part_open")))
    ends = F.transform("ends", lambda e: e + F.col("part_before") + F.col("before"))
    at = at.withColumn("places", ends).withColumn("doc", F.expr(
        "explode(transform(places, (e, i) -> named_struct('start', if(i = 0, from, places[i - 1] + 1), 'end', e, 'doc_id', ended[i])))"))
    closed = at.select("file", "doc.start", (F.col("doc.end") - F.col("doc.start")).alias("n_tokens"), F.lit(True).alias("closed"), "doc.doc_id")
    tails = last.select("file", F.coalesce("closed_at", F.lit(0)).alias("start"), (F.col("all") - F.coalesce("closed_at", F.lit(0))).alias("n_tokens"),
                        F.lit(False).alias("closed"), F.lit(None).cast("long").alias("doc_id"))
    return closed.union(tails.where("n_tokens > 0"))
