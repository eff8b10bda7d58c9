"""Near-duplicate documents by HyperMinHash, banding and exact confirmation.

A document is the set of its distinct word shingles (``hashing.words``: A-Z folded, words are
runs without space and 0x09 to 0x0D; fewer words than a shingle: the whole sequence is
one). One hash function deals the shingles to ``REGISTERS`` buckets; a register holds the
leading-zero count (6 bits) and ten mantissa bits of its bucket's smallest hash. Empty buckets
borrow by fixed random orders, so that small sets fill their registers too. ``BANDS``
bands of ``ROWS`` registers find candidates: at similarity 0.8 a pair shares no band once in
300,000 times, and then may still be linked through other documents.

Candidates and links:

1. Documents with equal sets (128-bit sums over the set) become one.
2. In each bucket of a band every member is a candidate with ``CENTERS`` members only: the first by
   each of as many fixed orders of all ids, so that a group of copies has the same centers in
   every band. The register estimate, corrected for expected collisions, discards pairs far
   below the threshold; the rest is confirmed on the full sets. Confirmed links are merged
   into components.
3. In buckets that still hold several components, the members outside the largest are compared with
   it and with each other, in blocks of at most ``2 * BLOCK`` members: by their registers first, and what
   may be similar, in the first band that the pair shares, on the full sets. So no pair of a bucket is
   left out, pairs inside a component, which can't change the result, are never looked at, and only
   links leave a block.

Joins that carry texts or registers are sort-merge joins at every size.

Edge cases: a null or empty text, or one without words, has an empty set and links with nothing.
Rows with a null id take no part in linking and come back with a null component, kept. Rows that repeat
an id count as one document as to the components and each comes back. Ties of equal sets go to the smallest id. An
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map, components, map_rows
from ordergate.llm.hashing import U, mix, shingles, text_slices, words

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
BLOCK = 256
CENTERS = 4
#: How far below the threshold an estimate may lie before the pair is discarded unconfirmed.
MARGIN = 0.18
SMALL = 30
_ORDER = np.stack([np.random.default_rng([11, i]).permutation(REGISTERS) for i in range(REGISTERS)])
_BAND = np.random.default_rng(12).integers(1, 1 << 62, ROWS).astype(U) * U(2) + U(1)
SKETCH = "id long, n long, set_a long, set_b long, sketch binary"


def distinct_shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for low, high, data, offsets in text_slices(texts):
        _, _, rows, hashes = words(data, offsets)
        grams, bounds = shingles(rows, hashes, high - low, size)
        out += [np.unique(grams[bounds[r] : bounds[r + 1]]) for r in range(high - low)]
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers of each set, rows x ``REGISTERS``; all zero for an empty set."""
    counts = np.array([len(s) for s in sets])
    table = np.zeros((len(sets), REGISTERS), np.uint16)
    if not counts.sum():
        return table
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), counts)
    place = row * REGISTERS + ((every >> U(32)) * U(REGISTERS) >> U(32)).astype(np.int64)  # ascending, as sets are sorted
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    least = np.minimum.reduceat(mix(every, 3), starts)
    share, bits = np.frexp((least >> U(11)).astype(np.float64) + 0.5)
    zeros = np.clip(53 - bits, 0, 62)
    table.reshape(-1)[place[starts]] = ((zeros + 1) << MANTISSA) + ((share * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    filled = table > 0
    r, j = np.nonzero(~filled & (counts > 0)[:, None])
    for t in range(REGISTERS):
        if not len(r):
            break
        source = _ORDER[j, t]
        hit = filled[r, source]
        table[r[hit], j[hit]] = table[r[hit], source[hit]]
        r, j = r[~hit], j[~hit]
    return table


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs of register rows, less the collisions expected of unrelated sets."""
    big, small = np.maximum(n_a, n_b), np.maximum(np.minimum(n_a, n_b), 1)
    ratio = big / small
    chance = 0.169919487159739 / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return (a == b).mean(1) - chance


def _possible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimates leave a link possible. Small sets, of uncertain estimates, always may be linked."""
    return (estimate(a, b, n_a, n_b) >= percent / 100 - MARGIN) | (np.minimum(n_a, n_b) < SMALL)


def sketches(docs: DataFrame, size: int, id_: str = "doc_id", text: str = "text") -> DataFrame:
    def run(batch):
        for low, high, *_ in text_slices(batch.column(1)):
            sets = distinct_shingles(batch.column(1)[low:high], size)
            sums = [np.array([mix(s, k).sum(dtype=U) for s in sets], U).view(np.int64) for k in (1, 2)]
            table = registers(sets)
            yield {"id": batch.column(0)[low:high], "n": pa.array([len(s) for s in sets], pa.int64()), "set_a": pa.array(sums[0]),
                   "set_b": pa.array(sums[1]), "sketch": pa.array([t.tobytes() for t in table], pa.binary())}

    return map_rows(docs.select(F.col(id_).cast("long").alias("id"), F.col(text).cast("string").alias("text")), run, SKETCH)


def _table(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint16) for x in column.to_pylist()], np.uint16).reshape(len(column), REGISTERS)


def _band_keys(table: np.ndarray) -> np.ndarray:
    keys = (table.astype(U).reshape(-1, BANDS, ROWS) * _BAND).sum(2, dtype=U)
    return mix(keys + np.arange(1, BANDS + 1, dtype=U) * U(0x632BE59BD9B4E019)).view(np.int64)


def _bands(reps: DataFrame) -> DataFrame:
    def run(batch):
        keys = _band_keys(_table(batch.column(1)))
        yield {"band": pa.array(keys.reshape(-1)), "id": pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))}

    return map_rows(reps.select("id", "sketch"), run, "band long, id long")


def _likely(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and registers leave possible."""
    side = [table.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]
    joined = pairs.join(side[0].hint("merge"), "a").join(side[1].hint("merge"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batch):
        a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
        ok = _possible(_table(batch.column(4)), _table(batch.column(5)), n_a, n_b, percent)
        yield {"a": pa.array(a[ok]), "b": pa.array(b[ok])}

    return map_rows(joined.select("a", "b", "n_a", "n_b", "s_a", "s_b"), run, "a long, b long")


def _confirm(pairs: DataFrame, texts: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets meet the threshold."""
    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("t_a")).hint("merge"), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("t_b")).hint("merge"), "b").select("a", "b", "t_a", "t_b")

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for whole in batches:
            for low in range(0, len(whole), 200):
                batch = whole.slice(low, 200)
                a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                if len(known) > 400:
                    known.clear()
                for ids_, column in ((a, batch.column(2)), (b, batch.column(3))):
                    new = [i for i, x in enumerate(ids_) if x not in known]
                    sets = distinct_shingles(column.take(pa.array(new, pa.int64())), size)
                    known.update(zip((ids_[i] for i in new), sets, strict=True))
                same = [len(np.intersect1d(known[x], known[y], assume_unique=True)) for x, y in zip(a, b, strict=True)]
                ok = np.array([100 * s >= percent * (len(known[x]) + len(known[y]) - s) for s, x, y in zip(same, a, b, strict=True)], bool)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()).filter(pa.array(ok)), "b": pa.array(b, pa.int64()).filter(pa.array(ok))})

    return scratch.keep(arrow_map(joined, run, "a long, b long"))


def _full(texts: DataFrame, size: int) -> DataFrame:
    """Rows (id, shingles): the sorted distinct shingle hashes of each text, packed."""

    def run(batch):
        for low, high, *_ in text_slices(batch.column(1)):
            sets = distinct_shingles(batch.column(1)[low:high], size)
            yield {"id": batch.column(0)[low:high], "shingles": pa.array([x.tobytes() for x in sets], pa.binary())}

    return map_rows(texts.select("id", "text"), run, "id long, shingles binary")


def _across(members: DataFrame, texts: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """Links (a, b) between different components within the buckets of ``members`` (band, id, component), by blocks."""
    shares = members.groupBy("band", "component").agg(F.count("*").alias("share"))
    tops = shares.groupBy("band").agg(F.max(F.struct("share", "component")).alias("top"), F.sum("share").alias("size"))
    dealt = members.join(tops, "band").withColumns({
        "inner": F.col("component") == F.col("top.component"),
        "inners": F.ceil(F.col("top.share") / BLOCK).cast("int"), "outers": F.ceil((F.col("size") - F.col("top.share")) / BLOCK).cast("int")})
    # Outer blocks are numbered from 0, those of the largest component from -1 down. Each group is a pair of blocks, one outer at least.
    dealt = dealt.withColumn("own", F.when(F.col("inner"), -1 - F.pmod(F.xxhash64("id"), F.col("inners"))).otherwise(F.pmod(F.xxhash64("id"), F.col("outers"))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("inner"), F.sequence(F.lit(0), F.col("outers") - 1)).otherwise(
        F.sequence(-F.col("inners"), F.col("outers") - 1))))
    dealt = dealt.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "component", "own")
    full = scratch.keep(_full(texts.join(members.select("id").distinct().hint("merge"), "id", "left_semi"), size))
    dealt = dealt.join(full.hint("merge"), "id").select("band", "low", "high", "own", "id", "component", "shingles")
    dealt = dealt.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")

    def links(t: pa.Table):
        band, low, high, own, id_, comp = (t.column(i).to_numpy() for i in range(6))
        sets = [np.frombuffer(x, U) for x in t.column(6).to_pylist()]
        n = np.array([len(x) for x in sets])
        sk = registers(sets)
        keys = _band_keys(sk)
        found = []
        for d in range(1, len(id_)):
            i = np.flatnonzero((band[:-d] == band[d:]) & (low[:-d] == low[d:]) & (high[:-d] == high[d:]))
            if not len(i):
                break
            j = i + d
            ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            ok &= (low[i] == high[i]) | (own[i] != own[j])  # members of one block meet in its own group only
            i, j = i[ok], j[ok]
            shared = keys[i] == keys[j]
            ok = keys[i, shared.argmax(1)] == band[i]  # the first band that they share
            i, j = i[ok], j[ok]
            ok = _possible(sk[i], sk[j], n[i], n[j], percent)
            for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                same = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * same >= percent * (n[x] + n[y] - same):
                    found.append((min(id_[x], id_[y]), max(id_[x], id_[y])))
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    def run(batches):
        held = None  # the group that may go on in the next batch
        for batch in batches:
            t = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            keys = np.stack([t.column(i).to_numpy() for i in range(3)], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            cut = int(cuts[-1]) if len(cuts) else 0
            for at in range(0, cut, 4096):
                # whole groups near every 4096 rows
                lo = 0 if at == 0 else int(cuts[min(np.searchsorted(cuts, at), len(cuts) - 1)])
                hi = int(cuts[min(np.searchsorted(cuts, at + 4096), len(cuts) - 1)])
                if hi > lo:
                    yield links(t.slice(lo, hi - lo))
            held = t.slice(cut)
        if held is not None and len(held):
            yield links(held)

    return scratch.keep(arrow_map(dealt, run, "a long, b long"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of every document; documents with
    ``100 * intersection >= percent * union`` are linked."""
    scratch = Scratch(docs.sparkSession, "near")
    source = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    table = scratch.keep(sketches(source, size, "id"))
    sets = scratch.keep(table.where("n > 0 and id is not null").groupBy("set_a", "set_b", "n").agg(F.min("id").alias("rep")))
    reps = scratch.keep(table.join(sets.select(F.col("rep").alias("id"), "set_a", "set_b", "n"), ["id", "set_a", "set_b", "n"], "left_semi")
                        .groupBy("id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    bands = _bands(reps)
    orders = [F.col("id"), *(F.xxhash64(F.col("id"), F.lit(k)) for k in range(1, CENTERS))]
    centers = bands.groupBy("band").agg(
        F.array(*(F.min(F.struct(o.alias("by"), "id")).getField("id") for o in orders)).alias("centers"), F.count("*").alias("size")).where("size > 1")
    members = scratch.keep(bands.join(centers, "band"))
    texts = scratch.keep(source.join(members.select("id").distinct().hint("merge"), "id", "left_semi"))
    pairs = members.select("id", F.explode(F.array_distinct("centers")).alias("center")).where("id <> center")
    pairs = scratch.keep(_likely(pairs.select(F.least("id", "center").alias("a"), F.greatest("id", "center").alias("b")).distinct(), reps, percent))
    links = _confirm(pairs, texts, scratch, size, percent)
    found = components(links, scratch)

    label = members.join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    mixed = label.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band")
    more = _across(scratch.keep(label.join(mixed, "band", "left_semi")), texts, scratch, size, percent)
    if not more.isEmpty():
        found = components(links.union(more), scratch)

    return (
        table.select("id", "n", "set_a", "set_b").join(sets, ["set_a", "set_b", "n"], "left")
        .join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
