"""Token ids of a byte-level BPE with word ends, as given by a ``tokenizers`` file, for many texts at a time.

Equal in result to ``Tokenizer.encode(text, add_special_tokens=False)``. A text is cut at spaces and
line feeds, over which neither normalisation nor pre-tokenisation reaches. Chunks are looked up in a
bounded cache; new ones of plain Latin letters are split by the file's own rule, and their new words are merged
together: words of equal length form a matrix, and in each round every word merges
its lowest-ranked pair. Anything else (other scripts, combining marks, very long words, the texts of special tokens) goes
to the library itself. Loading checks that the file is of the kind assumed here; for other files all chunks go
to the library.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 700_000
LONGEST = 40
_NONE = np.iinfo(np.int32).max  # no rank
_PLAIN = re.compile(rf"^[!-~À-ÖØ-öø-įĲ-ň]{{1,{LONGEST}}}$", re.M)  # NFC, and lower case letter by letter; one a line
# Fixed value: the split rule of such files, and what it comes to on plain chunks.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordPieces:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        self.known = (
            model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("ignore_merges") and not model.get("dropout")
            and [n["type"] for n in spec["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and pre["type"] == "Sequence" and pre["pretokenizers"][0].get("pattern") == {"Regex": _RULE})
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        if not self.known:
            return
        vocab, letters = model["vocab"], _byte_letters()
        self.letter = np.array([vocab[c] for c in letters], np.int64)
        self.last_letter = np.array([vocab[c + "</w>"] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # an open-addressed table, so that a lookup is a few gathers
        self.bits = 19
        slot = np.full(1 << self.bits, -1, np.int64)
        self.probes = 1
        place = self._place(keys)
        for i, p in enumerate(place.tolist()):
            step = 0
            while slot[(p + step) & ((1 << self.bits) - 1)] >= 0:
                step += 1
            slot[(p + step) & ((1 << self.bits) - 1)] = i
            self.probes = max(self.probes, step + 1)
        self.slot_key = np.where(slot >= 0, keys[np.maximum(slot, 0)], -1)
        self.slot_rank = np.where(slot >= 0, slot, _NONE)
        self.made = made

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32 | right).reshape(-1)
        at = self._place(keys)
        got = self.slot_key[at]
        rank = np.where(got == keys, self.slot_rank[at], _NONE)
        rest = np.flatnonzero((got != keys) & (got >= 0))
        for _ in range(1, self.probes):
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            got = self.slot_key[at[rest]]
            hit = got == keys[rest]
            rank[rest[hit]] = self.slot_rank[at[rest[hit]]]
            rest = rest[~hit & (got >= 0)]
        return rank.reshape(left.shape)

    def _merge(self, words: list[str]) -> list[bytes]:
        """Ids of words of as many bytes, as little-endian 32-bit bytes. Every word still open merges once a round, so
        all open ones have the same number of parts."""
        raw = np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), -1)
        ids = self.letter[raw]
        ids[:, -1] = self.last_letter[raw[:, -1]]
        out: list[bytes] = [b""] * len(words)
        who, width = np.arange(len(words)), ids.shape[1]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while len(who):
            row = np.arange(len(who))
            at = ranks.argmin(1) if width > 1 else np.zeros(len(who), np.int64)
            best = ranks[row, at] if width > 1 else np.full(len(who), _NONE)
            done = best == _NONE
            if done.any():
                flat, step = ids[done].astype("<u4").tobytes(), 4 * width
                for k, w in enumerate(who[done].tolist()):
                    out[w] = flat[k * step : (k + 1) * step]
                ids, ranks, who, at, best = (x[~done] for x in (ids, ranks, who, at, best))
                row = np.arange(len(who))
                if not len(who):
                    break
            # the right partner and the rank of the pair go: what follows moves one place to the left
            cols = np.arange(width)
            ids = ids[cols != at[:, None] + 1]
            ranks = ranks[cols[:-1] != at[:, None]]
            width -= 1
            ids, ranks = ids.reshape(len(who), width), ranks.reshape(len(who), width - 1)
            ids[row, at] = self.made[best]
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side + 1 < width))
                s = side[ok]
                ranks[ok, s] = self._ranks(ids[ok, s], ids[ok, s + 1])
        return out

    def _learn(self, chunks: list[str]) -> None:
        plain: list[str] = []
        if self.known:
            lines = "\n".join(chunks)
            plain = _PLAIN.findall(lines)
            if self.special.search(lines):
                plain = [c for c in plain if not self.special.search(c)]
        lower = "\n".join(plain).lower().split("\n") if plain else []
        # most chunks are one word, or one and a mark
        one = list(map(str.isalpha, lower))
        split = {c: (low[:-1], low[-1]) if low[-1] in ",." and low[:-1].isalpha() else _WORDS.findall(low)
                 for c, low, is_one in zip(plain, lower, one, strict=True) if not is_one}
        if len(self.words) > CACHE:
            self.words.clear()
        wanted = set(compress(lower, one)).union(*split.values())
        new: dict[int, list[str]] = {}
        for w in wanted.difference(self.words):
            new.setdefault(len(w.encode()), []).append(w)
        for group in new.values():
            self.words.update(zip(group, self._merge(group), strict=True))
        word = self.words.__getitem__
        self.chunks.update(zip(compress(plain, one), map(word, compress(lower, one)), strict=True))
        self.chunks.update((c, b"".join(map(word, ws))) for c, ws in split.items())
        if len(plain) < len(chunks):
            other = list(set(chunks).difference(plain))
            found = self.library.encode_batch(other, add_special_tokens=False)
            self.chunks.update(zip(other, (np.array(e.ids, "<u4").tobytes() for e in found), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        collecting = gc.isenabled()
        gc.disable()  # no cycles are made here, and the caches are slow to walk
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE:
            self.chunks = {"": b""}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        rows = [list(map(self.chunks.get, cs)) for cs in split]
        holes = [[i for i, x in enumerate(row) if x is None] for row in rows]
        new = {cs[i] for cs, at in zip(split, holes, strict=True) for i in at}
        if new:
            self._learn(list(new))
        for cs, row, at in zip(split, rows, holes, strict=True):
            for i in at:
                row[i] = self.chunks[cs[i]]
        return [b"".join(row) for row in rows]


def portions(texts: pa.Array, rows: int = 1000, letters: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of texts to be encoded at a time: first row, row after the last. Many texts share the work on their new words,
    but few very long ones are enough."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    low = 0
    while low < len(sizes):
        ends = np.cumsum(sizes[low : low + rows])
        high = low + max(1, int(np.searchsorted(ends, letters, "right")))
        yield low, high
        low = high


_loaded: dict[str, WordPieces] = {}


def word_pieces(path: str) -> WordPieces:
    """The tokenizer of a file, once in a process."""
    if path not in _loaded:
        _loaded[path] = WordPieces(path)
    return _loaded[path]
