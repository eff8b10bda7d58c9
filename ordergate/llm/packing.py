"""Best-fit packing of documents into sequences by a configuration linear program.

Documents are token ids followed by id 0. Longer ones than a sequence are cut into whole sequences and a last
piece. All that packing needs to know is how many pieces of each length there are: a
histogram of ``capacity`` entries at most, whatever the corpus. On it the driver solves

    minimise the number of sequences, over configurations (how many pieces of each length a sequence takes),
    so that every piece is taken,

by multiplicative weights: lengths little covered so far weigh more; the configuration of most weight
is found by dynamic programming over the capacity (an unbounded knapsack) and used for a share of what it can
take. Rounded down, configurations take what is there; what remains is filled best-fit, longest piece first, each
next piece the longest that fits. This plan is taken unless best fit alone needs fewer sequences.

Pieces get their places without a sort or a task per length: a piece's number among those of its length
is its number within its partition plus the counts of the partitions before, and the plan maps numbers to sequences.

Edge cases: a null or empty text is one piece, id 0 alone; documents of the same id or text are packed each; ties between
pieces of one length are broken by partition and order of reading; an empty table yields no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map
from ordergate.llm.tokens import portions, word_pieces

CAPACITY = 2048
STEPS, SHARE, SHARPNESS = 400, 0.5, 8.0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, nth long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, block, nth): the pieces of every document.
    ``block`` is the partition and ``nth`` the piece's number among those of its length there."""

    def run(batches):
        encoder, block, seen = word_pieces(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        step = capacity * 4
        for batch in batches:
            for low, high in portions(batch.column(1)):
                part = batch.slice(low, high - low)
                out: list[list] = [[] for _ in range(7)]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids += b"\0\0\0\0"
                    for n, start in enumerate(range(0, len(ids), step)):
                        body = ids[start : start + step]
                        size = len(body) // 4
                        for column, value in zip(out, (doc, n, start // 4, size, zlib.crc32(body), block, seen[size]), strict=True):
                            column.append(value)
                        seen[size] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return arrow_map(docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, PIECES)


def _heaviest(weight: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of most weight (index of size -> pieces), by dynamic programming over the capacity."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            worth = best[c - sizes[: fits[c]]] + weight[: fits[c]]
            i = int(worth.argmax())
            if worth[i] > best[c]:
                best[c], taken[c] = worth[i], i
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
            continue
        found[int(taken[c])] = found.get(int(taken[c]), 0) + 1
        c -= int(sizes[taken[c]])
    return found


def _best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations with their numbers for all that is left: longest first, then the longest that fits."""
    left, plan = left.copy(), []
    while left.any():
        use: dict[int, int] = {}
        room = capacity
        while True:
            free = np.flatnonzero(left[: np.searchsorted(sizes, room, "right")])
            i = next((int(i) for i in free[::-1] if left[i] > use.get(int(i), 0)), None)
            if i is None:
                break
            use[i] = use.get(i, 0) + 1
            room -= int(sizes[i])
        times = min(int(left[i]) // n for i, n in use.items())
        for i, n in use.items():
            left[i] -= n * times
        plan.append((use, times))
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Configurations (length -> pieces) with the number of sequences of each; together they take every piece."""
    full = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    sizes = np.array(sorted(s for s, n in histogram.items() if n and s < capacity), np.int64)
    if not len(sizes):
        return full
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    covered, use = np.zeros(len(sizes)), {}
    for _ in range(STEPS):
        weight = np.exp(-SHARPNESS * covered) * sizes
        weight[covered >= 1] = 0
        if not weight.any():
            break
        pick = _heaviest(weight, sizes, capacity)
        room = min(demand[i] * max(1 - covered[i], 0) / n for i, n in pick.items())
        amount = max(SHARE * room, min(room, 1.0))
        for i, n in pick.items():
            covered[i] += amount * n / demand[i]
        key = tuple(sorted(pick.items()))
        use[key] = use.get(key, 0.0) + amount
    left, plan = demand.copy(), []
    fill = lambda key: sum(int(sizes[i]) * n for i, n in key)
    for key in sorted(use, key=lambda k: (-fill(k), k)):
        times = min(int(use[key] + 1e-9), *(int(left[i]) // n for i, n in key))
        if times:
            for i, n in key:
                left[i] -= n * times
            plan.append((dict(key), times))
    plan += _best_fit(sizes, left, capacity)
    plain = _best_fit(sizes, demand, capacity)
    sequences = lambda p: sum(n for _, n in p)
    best = plan if sequences(plan) <= sequences(plain) else plain
    return full + [({int(sizes[i]): n for i, n in use_.items()}, times) for use_, times in best]


@dataclass(frozen=True)
class Places:
    """For each length in turn: from which number on, which sequences, how many, and where in them."""

    key: np.ndarray  # length << 44 | first number
    base: np.ndarray
    times: np.ndarray
    first: np.ndarray
    offset: np.ndarray


def _places(plan: list[tuple[dict[int, int], int]]) -> Places:
    rows, given, sequence = [], {}, 0
    for use, times in plan:
        offset = 0
        for size, n in sorted(use.items(), reverse=True):
            first = given.get(size, 0)
            rows.append((size << 44 | first, sequence, times, first, offset))
            given[size] = first + n * times
            offset += size * n
        sequence += times
    return Places(*(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.keep(pieces(docs, tokenizer, capacity, id_, text))
    counts = cut.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    places = spark.sparkContext.broadcast(_places(solve(histogram, capacity)))
    numbered = cut.join(before.select("length", "block", "before"), ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number"))

    def run(batches):
        p = places.value
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            i = np.searchsorted(p.key, length << 44 | number, "right") - 1
            k = number - p.first[i]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(p.base[i] + k % p.times[i]), pa.array(p.offset[i] + k // p.times[i] * length)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return arrow_map(numbered, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
