"""SentencePiece encoding and decoding by batched Viterbi.

Encoding finds the segmentation of most total score over the pieces of a SentencePiece model file.
Spaces become the mark U+2581 and one is put in front, as the file says; no piece reaches from another character
into a mark, so texts are cut before marks and equal chunks are segmented once while they are in a bounded cache. New
chunks advance together. First, from every character of all of them, the pieces that start there are found by a walk
through the trie of pieces, one step of all walks at a time; walks that leave the trie end. Then, character by character, a
maximum over the lengths of the pieces that end there stores the way back. Characters that no piece covers become byte pieces.

Scores: a unigram model's own. The pieces of a BPE model carry merge ranks, which are no
log-probabilities; they are read as ``-log(1 + rank)``, the shape of a Zipf law. (So a BPE
file's pieces are used, not its merge order; the ids need not be those of the merges.) Sums are in single precision and ties go to
the longer last piece, as in the public library's unigram mode, which tests compare with.

Edge cases: a null text gives null ids, an empty one none. Decoding gives back every text exactly, but for a literal U+2581, which
reads as a space. Very long chunks are segmented alone and not kept. Repeated rows get equal results; other columns are carried through.
"""

from __future__ import annotations

import gc
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ordergate.llm.frames import arrow_map

MARK = "▁"
CACHE = 600_000
LONGEST = 64
#: Characters segmented together, where there are more chunks.
CELLS = 1 << 17
_CODE = 21  # bits of a character


def _read(path: str):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model


def piece_scores(model) -> np.ndarray:
    """The score of each piece, see the module's text."""
    raw = np.array([p.score for p in model.pieces], np.float64)
    if model.trainer_spec.model_type == 2:  # BPE
        raw = -np.log1p(np.minimum(-raw, len(raw)))
    return raw.astype(np.float32)


class Pieces:
    def __init__(self, path: str):
        model = _read(path)
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only files without normalisation and with marks before words are supported")
        self.prefix = " " if spec.add_dummy_prefix else ""
        scores = piece_scores(model)
        normal = [i for i, p in enumerate(model.pieces) if p.type == 1]
        if any(MARK in p.piece.lstrip(MARK) for p in model.pieces if p.type == 1):
            raise ValueError("a piece holds a mark behind another character")
        self.byte_ids = np.array([next(i for i, p in enumerate(model.pieces) if p.type == 6 and p.piece == f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.longest = max(len(model.pieces[i].piece) for i in normal)
        self._grow({model.pieces[i].piece: i for i in normal}, scores)
        self.unknown = np.float32(scores[normal].min() - np.float32(10))
        self.chunks: dict[str, bytes] = {}
        self.bytes = [b""] * len(model.pieces)
        self.letters = [len(p.piece) for p in model.pieces]
        for i, p in enumerate(model.pieces):
            if p.type == 1:
                self.bytes[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == 6:
                self.bytes[i] = bytes([int(p.piece[3:5], 16)])

    def _grow(self, pieces: dict[str, int], scores: np.ndarray) -> None:
        """The trie: its edges (node, character) in an open-addressed table, and the piece and score of each node."""
        edges: dict[int, int] = {}
        ends = {}
        for piece, i in pieces.items():
            node = 0
            for c in piece:
                node = edges.setdefault(node << _CODE | ord(c), len(edges) + 1)
            ends[node] = i
        self.node_id = np.full(len(edges) + 1, -1, np.int32)
        self.node_id[list(ends)] = list(ends.values())
        self.node_score = np.where(self.node_id >= 0, scores[self.node_id], np.float32(-np.inf))
        self.bits = max(4, (4 * len(edges)).bit_length())
        size = 1 << self.bits
        keys, to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        self.probes = 1
        for key, place, node in zip(edges, self._place(np.array(list(edges), np.int64)).tolist(), edges.values(), strict=True):
            step = 0
            while keys[(place + step) & (size - 1)] >= 0:
                step += 1
            keys[(place + step) & (size - 1)], to[(place + step) & (size - 1)] = key, node
            self.probes = max(self.probes, step + 1)
        self.edge_key, self.edge_to = keys, to

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _follow(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node that each edge leads to; 0 where there is none."""
        keys = nodes << _CODE | codes
        at = self._place(keys)
        got = self.edge_key[at]
        out = np.where(got == keys, self.edge_to[at], 0)
        rest = np.flatnonzero((got != keys) & (got >= 0))
        for _ in range(1, self.probes):
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            got = self.edge_key[at[rest]]
            hit = got == keys[rest]
            out[rest[hit]] = self.edge_to[at[rest[hit]]]
            rest = rest[~hit & (got >= 0)]
        return out

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, none empty, as little-endian 32-bit bytes.

        Longer chunks come first and characters lie place by place: those of one place belong to the first rows."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        by = np.argsort(-sizes, kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[by], sizes[by]
        flat = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n, width = len(chunks), int(sizes[0])
        rows_at = np.searchsorted(-sizes, -np.arange(1, width + 1), "right")  # rows that have a character at each place
        first = np.concatenate([[0], np.cumsum(rows_at)])
        codes = np.concatenate([flat[starts[:m] + p] for p, m in enumerate(rows_at.tolist())])
        place = np.repeat(np.arange(width), rows_at)
        row = np.arange(len(codes)) - first[place]
        # the piece of each length that starts at each character
        ids: list[np.ndarray | None] = [None]
        scores: list[np.ndarray | None] = [None]
        live, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for size in range(1, min(self.longest, width) + 1):
            if size > 1:
                ok = sizes[row[live]] >= place[live] + size
                live, node = live[ok], node[ok]
            node = self._follow(node, codes[first[place[live] + size - 1] + row[live]]).astype(np.int64)
            ok = node > 0
            live, node = live[ok], node[ok]
            found = self.node_id[node]
            if size > 1 and not (found >= 0).any():
                ids.append(None)
                scores.append(None)
                continue
            ids.append(np.full(len(codes), -1, np.int32))
            scores.append(np.full(len(codes), -np.inf, np.float32))
            ids[-1][live], scores[-1][live] = found, self.node_score[node]
        # best[first[p]...] belongs to the ends behind the characters of place p
        unknown = ids[1] < 0
        scores[1][unknown] = self.unknown
        edge, best, back = np.zeros(n, np.float32), np.empty(len(codes), np.float32), np.ones(len(codes), np.int64)
        for p, m in enumerate(rows_at.tolist()):
            low = first[p]
            now, way = np.full(m, -np.inf, np.float32), back[low : low + m]
            for size in range(min(len(ids) - 1, p + 1), 0, -1):  # the longest first, so that it wins ties
                if scores[size] is None:
                    continue
                start = first[p + 1 - size]
                score = (edge if size == p + 1 else best[first[p - size] : first[p - size] + m])[:m] + scores[size][start : start + m]
                better = score > now
                np.copyto(now, score, where=better)
                np.copyto(way, size, where=better)
            best[low : low + m] = now
        taken = np.empty(len(codes), np.int32)
        for size in range(1, len(ids)):
            if ids[size] is not None:
                at = np.flatnonzero(back == size)
                taken[at] = ids[size][first[place[at] + 1 - size] + row[at]]
        # the way back, the last piece first
        live, end, steps = np.arange(n), sizes.copy(), []
        count = np.zeros(n, np.int64)
        while len(live):
            at = first[end - 1] + live
            steps.append((live, at))
            count[live] += 1
            end = end - back[at]
            live, end = live[end > 0], end[end > 0]
        offset = np.concatenate([[0], np.cumsum(count)])
        got, whose = np.empty(offset[-1], "<i4"), np.zeros(n, bool)
        for k, (rows, at) in enumerate(steps):
            got[offset[rows + 1] - 1 - k] = taken[at]
            whose[rows[taken[at] < 0]] = True
        raw, bounds = got.tobytes(), (4 * offset).tolist()
        out: list[bytes] = [b""] * n
        for r, i in enumerate(by.tolist()):
            out[i] = raw[bounds[r] : bounds[r + 1]]
        for r in np.flatnonzero(whose).tolist():
            out[by[r]] = self._with_bytes(chunks[by[r]], got[offset[r] : offset[r + 1]].tolist())
        return out

    def _with_bytes(self, chunk: str, ids: list[int]) -> bytes:
        """Ids with the byte pieces of each character that is none (-1)."""
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(i)
                at += self.letters[i]
            else:
                out.extend(self.byte_ids[list(chunk[at].encode("utf-8", "surrogatepass"))].tolist())
                at += 1
        return np.array(out, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        collecting = gc.isenabled()
        gc.disable()  # no cycles are made here, and the cache is slow to walk
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        split = [_CHUNK.findall((self.prefix + t).replace(" ", MARK)) if t else [] for t in texts]
        new = sorted(set().union(*split).difference(self.chunks), key=len)
        extra: dict[str, bytes] = {}
        at = 0
        while at < len(new):
            size, end = 0, at
            while end < len(new) and (end == at or size + len(new[end]) <= CELLS) and (len(new[end]) <= LONGEST or end == at):
                size += len(new[end])
                end += 1
            part = new[at:end]
            (self.chunks if len(part[-1]) <= LONGEST else extra).update(zip(part, self._segment(part), strict=True))
            at = end
        known = self.chunks.__getitem__ if not extra else lambda c: self.chunks[c] if c in self.chunks else extra[c]
        return [b"".join(map(known, cs)) for cs in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        look = self.bytes.__getitem__
        texts = [b"".join(map(look, x.tolist())).decode("utf-8", "replace") for x in ids]
        return [t.removeprefix(self.prefix) for t in texts]


_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_loaded: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The pieces of a model file, once in a process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _column_map(docs: DataFrame, source: str, target: str, kind: T.DataType, fn) -> DataFrame:
    docs = docs.drop(target)
    at = docs.columns.index(source)

    def run(batches):
        for whole in batches:
            for low in range(0, len(whole), 250):
                batch = whole.slice(low, 250)
                yield pa.RecordBatch.from_arrays([*batch.columns, fn(batch.column(at))], names=[*batch.schema.names, target])

    return arrow_map(docs, run, T.StructType([*docs.schema.fields, T.StructField(target, kind)]))


def _ids_array(packed: list[bytes | None]) -> pa.Array:
    sizes = [0 if x is None else len(x) // 4 for x in packed]
    flat = np.frombuffer(b"".join(x or b"" for x in packed), "<i4")
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat),
                                     mask=pa.array([x is None for x in packed]))
    return lists


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) of each text."""

    def run(column):
        texts = column.to_pylist()
        return _ids_array([None if t is None else x for t, x in zip(texts, pieces_of(model).encode([t or "" for t in texts]), strict=True)])

    return _column_map(docs, text, ids, T.ArrayType(T.IntegerType()), run)


def decode(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that each ``ids`` stands for."""

    def run(column):
        flat = column.flatten().fill_null(0).to_numpy()
        ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy())
        found = pieces_of(model).decode(np.split(flat, ends[:-1])) if len(ends) else []
        return pa.array(found, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))

    return _column_map(docs, ids, text, T.StringType(), run)
