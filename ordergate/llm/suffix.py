"""Removal of repeated strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the
same text or another, is removed. Texts are UTF-8 bytes; matches never cross texts;
strings are judged on the input.

How it is done on tables that no machine holds:

1. *Anchors.* In any ``window`` (``WINDOW``, or two fifths of a shorter ``length``) consecutive byte 16-grams, the one with the smallest hash is
   an anchor. Equal strings pick equal anchors, and a string whose anchor lies at ``a`` holds
   the ``length - window + 1`` bytes from ``a`` on: their hash is the anchor's key. A string can only
   repeat if its key does. Keys are counted with partial sums, so a passage in a
   third of all texts costs no task more than others.
2. *Contexts.* What decides the rest are the ``window - 1`` bytes before and after the key. An
   anchor whose whole context occurs twice is settled by a count. Of the others one
   copy of each context goes on.
3. *Shards.* Contexts with one key meet in one shard; the key, whatever its length, is a single
   symbol there. Each shard's suffix array is built by Larsson-Sadakane refinement (groups of suffixes
   not yet told apart are sorted by the rank of what follows, over doubled
   lengths), and common prefixes follow by Kasai's lemma: only where the preceding
   symbols differ is a prefix measured, elsewhere it is one less than its predecessor's.
4. *Merging.* A key with more than ``SHARD_CONTEXTS`` contexts is dealt to several shards. Their sorted
   windows, one of each kind, are dealt by hash, and binary search finds those that another shard has too.

Rows are told apart by a 64-bit hash of id and text. Edge cases: a null text is empty; texts shorter than
``length`` lose nothing; a row that occurs twice is its own repetition, so both lose
everything (from ``length`` bytes on); null ids are ids like others; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, arrow_map, map_rows
from ordergate.llm.hashing import BYTE_VALUES, U, Prefix, mix, sliding, text_slices

GRAM, WINDOW = 16, 96
SHARD_CONTEXTS = 512
SHARD_SYMBOLS = 1 << 18
MERGED_LENGTH = 400


def _window(length: int) -> int:
    return max(1, min(WINDOW, length * 2 // 5))


def row_key(id_: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart."""
    return F.xxhash64(F.col(id_).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit("")))


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """Rows (uid, pos, key) of every anchor whose key lies within its text."""
    window = _window(length)
    span, gram = length - window + 1, min(GRAM, length - window + 1)

    def run(batch):
        uid = batch.column(0).to_numpy()
        for low, high, data, offsets in text_slices(batch.column(1)):
            if len(data) < length:
                continue
            prefix = Prefix(BYTE_VALUES[data])
            h = (prefix.grams(gram) >> U(32)).astype(np.uint32)
            least = sliding(h, window, np.minimum)
            edge = np.zeros(window - 1, np.uint32)
            most = sliding(np.concatenate([edge, least, edge]), window, np.maximum)
            pos = np.flatnonzero(h[: len(most)] == most)
            row = np.searchsorted(offsets, pos, "right") - 1
            fits = (pos + span <= offsets[row + 1]) & (np.diff(offsets)[row] >= length)
            pos, row = pos[fits], row[fits]
            yield {"uid": pa.array(uid[low:high][row]), "pos": pa.array((pos - offsets[row]).astype(np.int32)),
                   "key": pa.array(mix(prefix.of(pos, pos + span)).view(np.int64))}

    return map_rows(texts.select("uid", "text"), run, "uid long, pos int, key long")


def _lists(batch: pa.RecordBatch, column: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Fields of an array<struct> column, flat, and the bounds of each row."""
    lists = batch.column(column)
    flat, ends = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy()
    return [f.to_numpy(zero_copy_only=False) for f in flat.flatten()], np.concatenate([[0], np.cumsum(ends)])


def _contexts(suspects: DataFrame, length: int) -> DataFrame:
    """Rows (uid, pos, key, context, size): the hash of each suspect anchor's context, and its text's length."""
    window = _window(length)
    span = length - window + 1

    def run(batch):
        uid = batch.column(0).to_numpy()
        (all_pos, all_key), bounds = _lists(batch, 2)
        for low, high, data, offsets in text_slices(batch.column(1)):
            pos, key = all_pos[bounds[low] : bounds[high]].astype(np.int64), all_key[bounds[low] : bounds[high]]
            row = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
            at, size = pos + offsets[row], np.diff(offsets)[row]
            start, end = np.maximum(at - (window - 1), offsets[row]), np.minimum(at + span + window - 1, offsets[row] + size)
            shape = (at - start) * window + (end - at - span)
            context = mix(mix(Prefix(BYTE_VALUES[data]).of(start, end), 5) + shape.astype(U))
            yield {"uid": pa.array(uid[low:high][row]), "pos": pa.array(pos.astype(np.int32)), "key": pa.array(key),
                   "context": pa.array(context.view(np.int64)), "bytes": pa.array(size)}

    return map_rows(suspects.select("uid", "text", "found"), run, "uid long, pos int, key long, context long, bytes long")


def _neighbours(suspects: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes before and after the key of the wanted anchors (uid, pos, key, single, contexts)."""
    window = _window(length)
    span = length - window + 1
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("pos", "key", "single", "contexts")).alias("wanted"))
    joined = suspects.dropDuplicates(["uid"]).select("uid", "text").join(lists, "uid")

    def run(batch):
        uid = batch.column(0).to_numpy()
        (pos, key, single, contexts), bounds = _lists(batch, 2)
        for r, text in enumerate(batch.column(1).to_pylist()):
            raw, part = text.encode(), slice(bounds[r], bounds[r + 1])
            left = [raw[max(0, p - window + 1) : p] for p in pos[part].tolist()]
            right = [raw[p + span : p + span + window - 1] for p in pos[part].tolist()]
            yield {"uid": pa.array(np.repeat(uid[r], len(left))), "pos": pa.array(pos[part]), "key": pa.array(key[part]), "single": pa.array(single[part]),
                   "contexts": pa.array(contexts[part]), "left": pa.array(left, pa.binary()), "right": pa.array(right, pa.binary())}

    return map_rows(joined, run, "uid long, pos int, key long, single boolean, contexts long, left binary, right binary")


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of ``symbols`` in order (Larsson-Sadakane). The last symbol should be unique."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_ = symbols[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    slots = np.arange(n)
    h = 1
    while True:
        group = rank[order[slots]]
        loose = np.zeros(len(slots), bool)  # in a group with another
        same = group[1:] == group[:-1]
        loose[1:] |= same
        loose[:-1] |= same
        slots, group = slots[loose], group[loose]
        if not len(slots):
            return order
        suffixes = order[slots]
        follow = rank[np.minimum(suffixes + h, n)] + 1
        by = np.argsort(group * (n + 1) + follow, kind="stable")  # groups keep their slots
        suffixes, follow = suffixes[by], follow[by]
        order[slots] = suffixes
        first = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        rank[suffixes] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        h *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of ``order`` the common prefix with the place before (Kasai's lemma, by place in the text)."""
    n = len(symbols)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    place = np.arange(n)
    chained = (place > 0) & (before > 0)
    chained[chained] = symbols[place[chained] - 1] == symbols[before[chained] - 1]
    measured = np.flatnonzero(~chained)
    length = np.zeros(n, np.int64)
    live = measured[before[measured] >= 0]
    ended = np.append(symbols, -1)
    while len(live):
        at, other = live + length[live], before[live] + length[live]
        ok = (at < n) & (other < n)
        ok[ok] = ended[at[ok]] == ended[other[ok]]
        live = live[ok]
        length[live] += 1
    last = np.maximum.accumulate(np.where(chained, 0, place))
    return (length[last] - (place - last))[order]


def _shard(t: pa.Table, window: int) -> tuple[pa.RecordBatch | None, np.ndarray]:
    """Repeated window starts of one shard's contexts, and the first of each kind of window."""
    uid, pos, key, single, contexts = (t.column(c).to_numpy() for c in ("uid", "pos", "key", "single", "contexts"))
    left, right = t.column("left").to_pylist(), t.column("right").to_pylist()
    m = len(uid)
    n_left, n_right = np.fromiter(map(len, left), np.int64, m), np.fromiter(map(len, right), np.int64, m)
    body = np.frombuffer(b"".join(x + b"\0" + y + b"\0" for x, y in zip(left, right, strict=True)), np.uint8)
    begins = np.concatenate([[0], np.cumsum(n_left + n_right + 2)])[:-1]
    middle, ends = begins + n_left, begins + n_left + 1 + n_right
    symbols, values = body.astype(np.int64), BYTE_VALUES[body]
    _, group = np.unique(key, return_inverse=True)
    symbols[middle], values[middle] = 256 + group, mix(key.view(U), 9)
    symbols[ends] = 256 + m + np.arange(m)
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order)
    near = np.maximum(shared, np.append(shared[1:], 0))
    repeated, first = np.zeros(len(symbols), bool), np.zeros(len(symbols), bool)
    repeated[order], first[order] = near >= window, shared < window
    # starts whose window holds the key and ends before the terminator
    owner = np.repeat(np.arange(m), n_left + n_right + 2)
    at = np.arange(len(symbols))
    valid = (at <= middle[owner]) & (at + window <= ends[owner]) & (at + window > middle[owner])
    start = pos[owner].astype(np.int64) - (middle[owner] - at)
    hit = valid & repeated & single[owner]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    lo, hi = edge[::2], edge[1::2] - 1
    runs = (uid[owner[lo]], start[lo], start[hi])
    send = np.flatnonzero(valid & first & (contexts[owner] > SHARD_CONTEXTS))
    windows = mix(Prefix(values).of(send, send + window)).view(np.int64)
    return runs, (uid[owner[send]], start[send], windows, ~repeated[send] & single[owner[send]])


def _search(contexts: DataFrame, length: int) -> DataFrame:
    """Rows (uid, low, high, window): runs of repeated starts (window null), and for keys in several
    shards the first of each kind of window (high null where it isn't open)."""
    window = _window(length)
    shards = F.ceil(F.col("contexts") / SHARD_CONTEXTS)
    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("uid", "pos"), shards))
    dealt = dealt.repartition("key", "shard").sortWithinPartitions("key", "shard")

    def rows(t):
        (uid, lo, hi), (w_uid, w_start, w_hash, w_open) = _shard(t, window)
        yield pa.RecordBatch.from_pydict({
            "uid": pa.array(np.concatenate([uid, w_uid])), "low": pa.array(np.concatenate([lo, w_start])), "high": pa.array(np.concatenate([hi, w_start])),
            "window": pa.array(np.concatenate([np.zeros(len(uid), np.int64), w_hash]), mask=np.concatenate([np.ones(len(uid), bool), np.zeros(len(w_uid), bool)])),
            "open": pa.array(np.concatenate([np.zeros(len(uid), bool), w_open]))})

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            keys = np.stack([t.column("key").to_numpy(), t.column("shard").to_numpy()], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            done, step = 0, SHARD_SYMBOLS // (2 * window + 2)
            while len(cuts) and len(t) - done > step:
                after = cuts[cuts > done]
                if not len(after):
                    break
                cut = int(after[max(0, np.searchsorted(after, done + step, "right") - 1)])
                yield from rows(t.slice(done, cut - done).combine_chunks())
                done = cut
            held = t.slice(done)
        if held is not None and len(held):
            yield from rows(held.combine_chunks())

    return arrow_map(dealt, run, "uid long, low long, high long, window long, open boolean")


def _merge(windows: DataFrame) -> DataFrame:
    """Open windows that another shard has too."""

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            w = t.column("window").to_numpy()
            cut = int(np.searchsorted(w, w[-1], "left"))
            yield from twice(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield from twice(held)

    def twice(t):
        w = t.column("window").to_numpy()
        ok = (np.searchsorted(w, w, "right") - np.searchsorted(w, w, "left") > 1) & t.column("open").to_numpy()
        yield from t.select(["uid", "low", "high"]).filter(pa.array(ok)).to_batches()

    sorted_ = windows.select("uid", "low", "high", "window", "open").repartition("window").sortWithinPartitions("window")
    return arrow_map(sorted_, run, "uid long, low long, high long")


def _cover(starts: DataFrame, suspects: DataFrame, length: int) -> DataFrame:
    """Removed runs of bytes and what is left, of the texts that lose any."""
    lists = starts.groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    joined = suspects.dropDuplicates(["uid"]).select("uid", "text").join(lists, "uid")

    def run(batch):
        (lows, highs), bounds = _lists(batch, 2)
        uid, spans, kept, kept_text = batch.column(0), [], [], []
        for r, text in enumerate(batch.column(1).to_pylist()):
            raw = text.encode()
            lo, hi = lows[bounds[r] : bounds[r + 1]], highs[bounds[r] : bounds[r + 1]] + length
            by = np.argsort(lo)
            lo, hi = lo[by], np.maximum.accumulate(hi[by])
            new = np.concatenate([[True], lo[1:] > hi[:-1]])
            a, b = lo[new].tolist(), hi[np.append(np.flatnonzero(new)[1:], len(hi)) - 1].tolist()
            spans.append([{"start": x, "end": y} for x, y in zip(a, b, strict=True)])
            edges = [0, *(v for ab in zip(a, b, strict=True) for v in ab), len(raw)]
            kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            whole = [0]
            for x, y in zip(a, b, strict=True):  # characters cut by a span's end stay
                while x < y and raw[x] & 0xC0 == 0x80:
                    x += 1
                while y > x and y < len(raw) and raw[y] & 0xC0 == 0x80:
                    y -= 1
                whole += [x, y]
            whole.append(len(raw))
            kept_text.append(b"".join(raw[x:y] for x, y in zip(whole[::2], whole[1::2], strict=True)).decode())
        yield {"uid": uid, "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
               "kept": pa.array(kept, pa.binary()), "kept_text": pa.array(kept_text, pa.string())}

    return map_rows(joined, run, "uid long, spans array<struct<start:long,end:long>>, kept binary, kept_text string")


def repeated_strings(docs: DataFrame, length: int = MERGED_LENGTH, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (uid, spans, kept, kept_text) of the texts that lose bytes: the maximal removed runs, the bytes
    left, and the same as text where characters cut in two stay whole. ``uid`` is ``row_key``."""
    window = _window(length)
    scratch = Scratch(docs.sparkSession, "suffix")
    source = docs.select(row_key(id_, text).alias("uid"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where(F.octet_length("text") >= length)
    found = anchors(source, length)
    keys = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    suspect = found.join(keys, "key", "left_semi")
    lists = suspect.groupBy("uid").agg(F.collect_set(F.struct("pos", "key")).alias("found"))
    suspects = scratch.keep(source.join(lists, "uid"))
    contexts = scratch.keep(_contexts(suspects, length))
    kinds = scratch.keep(contexts.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct("uid", "pos")).alias("at")))
    several = kinds.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1")
    wanted = kinds.join(several, "key").select("at.uid", "at.pos", "key", (F.col("n") == 1).alias("single"), "contexts")
    searched = scratch.keep(_search(_neighbours(suspects, wanted, length), length))
    settled = contexts.join(kinds.where("n > 1").select("key", "context"), ["key", "context"], "left_semi").select(
        "uid", F.greatest(F.col("pos") - (window - 1), F.lit(0)).cast("long").alias("low"), F.least(F.col("pos").cast("long"), F.col("bytes") - length).alias("high"))
    starts = settled.where("low <= high").union(searched.where("window is null").select("uid", "low", "high")).union(
        _merge(searched.where("window is not null")))
    return _cover(starts.distinct(), suspects, length)


def stripped(docs: DataFrame, length: int = MERGED_LENGTH, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    lost = repeated_strings(docs, length, id_, text).select(
        "uid", F.octet_length("kept").alias("left"), F.size("spans").alias("runs"), F.sha2("kept", 256).alias("sha"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    every = docs.select(F.col(id_).alias("doc_id"), row_key(id_, text).alias("uid"), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole"))
    return every.join(lost, "uid", "left").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("left", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))
