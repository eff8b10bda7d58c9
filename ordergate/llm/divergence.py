"""How far the sources of a language differ in the terms they use.

Terms are runs of letters: A-Z, a-z (only A-Z are lower-cased) and every character beyond ASCII. Each language keeps the terms of at least
``min_docs`` of its documents. Every group (language, source), and each language as a whole, gives every kept term the share

    p = 1 + floor(``UNIT`` * (count + ``SMOOTH``) / (N + ``SMOOTH`` * V))

of its count, of the N kept occurrences in the group and the V kept terms of the language, all in whole numbers. Two sources differ by the sum of
abs(p - q) over all kept terms; a source's own terms are those it uses with p above the language's q.

1. *Counts.* Each task lower-cases, splits, dictionary-encodes and groups its texts in Arrow, some ``SLICE`` bytes at a time, into
   occurrences and documents by (language, source, term); what repeats in a task is added up before it leaves, in tables of ``HELD`` rows at most.
2. *Merge.* Counts are shuffled by language and term once: both the sums of each source and the documents of the language
   follow there. Frequent terms are few rows a task by then.
3. *Shards.* Kept terms are dealt to shards of about ``CELLS`` counts. In each, the counts become a matrix of terms by all sources of the language; each
   column's differences from all others are summed, and each source's best terms of the shard are found.
4. The sums of the shards are added up, and ranked.

Edge cases: null text, language or source count as empty; so a null and an empty source are one group. Groups without any term, and languages without
kept terms, have pairs (of value 0 in the latter) but no terms. A language with one source has no pairs. Repeated rows and repeated ids are documents
each. Texts are counted whole. Equal values are ranked by the item's UTF-8 bytes. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map, ship

UNIT, SMOOTH = 1_000_000_000, 5
MIN_DOCS, TOP = 30, 50
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SLICE, HELD, CELLS = 4 << 20, 1 << 19, 1 << 16


def _slices(batch: pa.RecordBatch, column: int) -> list[pa.RecordBatch]:
    """Runs of rows of about ``SLICE`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, low = [], 0
    while low < len(batch):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        out.append(batch.slice(low, high - low))
        low = high
    return out


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents (lang, source, term, n, docs) of rows (lang, source, text); each group also has a row of the empty term."""
    lang, source, text = batch.columns
    groups = pa.table({"lang": lang, "source": source}).append_column("row", pa.array(np.arange(len(batch)))).group_by(
        ["lang", "source"], use_threads=False).aggregate([("row", "list")])
    rows = groups["row_list"].combine_chunks()
    group_of = np.empty(len(batch), np.int32)
    group_of[rows.flatten().to_numpy()] = np.repeat(np.arange(len(groups), dtype=np.int32), rows.value_lengths().to_numpy())
    split = pc.split_pattern_regex(pc.ascii_lower(text), SEPARATORS)
    coded = split.flatten().dictionary_encode()
    terms = pa.table({"row": pc.list_parent_indices(split), "term": coded.indices})
    empty = pc.index(coded.dictionary, "").as_py()  # what stands before or after a text's separators
    if empty >= 0:
        terms = terms.filter(pc.not_equal(terms["term"], empty))
    by_row = terms.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    by_row = by_row.append_column("group", pa.array(group_of[by_row["row"].to_numpy()], pa.int32()))
    found = by_row.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
    where = pa.concat_arrays([found["group"].combine_chunks(), pa.array(np.arange(len(groups), dtype=np.int32))])
    what = pa.concat_arrays([coded.dictionary.take(found["term"].combine_chunks()), pa.array([""] * len(groups), coded.dictionary.type)])
    zeros = pa.array(np.zeros(len(groups), np.int64))
    return pa.table({
        "lang": groups["lang"].combine_chunks().take(where), "source": groups["source"].combine_chunks().take(where), "term": what,
        "n": pa.concat_arrays([found["count_all_sum"].combine_chunks().cast(pa.int64()), zeros]),
        "docs": pa.concat_arrays([found["count_all"].combine_chunks().cast(pa.int64()), zeros])})


def _added(tables: list[pa.Table]) -> pa.Table:
    names = ["lang", "source", "term", "n", "docs"]
    summed = pa.concat_tables(tables).group_by(names[:3], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(names)


def partial_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """Rows (lang, source, term, n, docs), several for a term where several tasks meet it."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in _slices(batch, 2):
                held.append(term_counts(part))
                size += len(held[-1])
                if size > HELD:
                    held = [_added(held)]
                    size = len(held[0])
                    if size > HELD // 2:
                        yield from held[0].to_batches(max_chunksize=1 << 16)
                        held, size = [], 0
        if held:
            yield from _added(held).to_batches(max_chunksize=1 << 16)

    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    return arrow_map(docs.select(*texts), run, "lang string, source string, term string, n long, docs long")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * counts / total) for 0 <= counts <= total, digit by digit (three at a time), so that nothing overflows."""
    share, rest = np.zeros(np.broadcast(counts, total).shape, np.int64), np.broadcast_to(counts, np.broadcast(counts, total).shape).astype(np.int64)
    for _ in range(3):  # UNIT is 1000 ** 3
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest = rest % total
    return share + 1


def _shard(lang: str, counts: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Sums of differences by pair of sources, and the best terms of each source, of one shard."""
    by = pc.sort_indices(groups["source"])
    groups = groups.take(by)
    sources = groups["source"].combine_chunks()
    n_group, v, n_lang = groups["n_group"].to_numpy(), groups["v"][0].as_py(), groups["n_lang"][0].as_py()
    coded = counts["term"].combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()  # rows of the matrix in the order of their bytes
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m = np.zeros((len(order), len(sources)), np.int64)
    m[place[coded.indices.to_numpy()], pc.index_in(counts["source"].combine_chunks(), sources).to_numpy()] = counts["n"].to_numpy()
    out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

    def emit(i, part, items, values):
        out["source"] += [sources[i].as_py()] * len(values)
        out["part"] += [part] * len(values)
        out["item"] += items.to_pylist()
        out["value"] += values.tolist()

    if len(order):
        p = shares(m + SMOOTH, (n_group + SMOOTH * v)[None, :])
        above = p - shares(m.sum(1) + SMOOTH, np.int64(n_lang + SMOOTH * v))[:, None]
    terms = coded.dictionary.take(pa.array(order))
    for i in range(len(sources)):
        others = np.delete(np.arange(len(sources)), i)
        apart = np.abs(p[:, others] - p[:, i : i + 1]).sum(0) if len(order) else np.zeros(len(others), np.int64)
        emit(i, "pair", sources.take(pa.array(others)), apart)
        if len(order):
            own = np.flatnonzero((m[:, i] > 0) & (above[:, i] > 0))
            best = own[np.argsort(-above[own, i], kind="stable")[:top]]
            emit(i, "term", terms.take(pa.array(best)), above[best, i])
    return pa.table({"lang": pa.array([lang] * len(out["value"]), pa.string()), "source": pa.array(out["source"], pa.string()), "part": pa.array(out["part"], pa.string()),
                     "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, part, item, value, rank): every other source by its difference (part ``pair``), and the ``top`` terms
    by their share above the language's (part ``term``)."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "divergence")
    # one shuffle: the sums by source and the window by term need no other partitioning
    partial = partial_counts(docs, text, lang, source).repartition("lang", "term")
    merged = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    merged = merged.withColumns({"all_docs": F.sum("docs").over(term), "first": F.row_number().over(term.orderBy("source")) == 1})
    kept = scratch.keep(merged.where((F.col("term") == "") | (F.col("all_docs") >= min_docs)).select("lang", "term", "source", "n", "first"))
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count_if(F.col("first") & (F.col("term") != "")).alias("firsts"))
    of_lang = Window.partitionBy("lang")
    groups = scratch.keep(groups.select("lang", "source", "n_group", F.sum("n_group").over(of_lang).alias("n_lang"),
                                        F.sum("firsts").over(of_lang).alias("v"), F.count("*").over(of_lang).alias("n_sources")))
    cells = groups.agg(F.max(F.col("v") * F.col("n_sources"))).collect()[0][0] or 0
    shards = max(1, -(-cells // CELLS))
    dealt = kept.where("term <> ''").select("lang", "term", "source", "n", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"))
    everywhere = groups.select("lang", "source", "n_group", "n_lang", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _shard(key[0].as_py(), left, right, top)

    found = dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard")).applyInArrow(
        run, "lang string, source string, part string, item string, value long")
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
