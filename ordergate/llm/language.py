"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased text are hashed to ``DIM`` features. Weights
are trained with follow-the-regularised-leader (FTRL-proximal) under an elastic net,
which leaves most of them exactly zero; a temperature then calibrates the probabilities.

Training reads about ``MAX_TRAIN`` labelled documents, a share of them by the hash of id and text, rows that repeat both being one
(the bound of the fitted sample; with fewer labelled documents it is all of them). Document frequencies for IDF are counted over all labelled documents given.
Prediction reads every whole text.

Results for edge cases: a null text, a text without a letter (empty ones too), or a model that saw
no label gives ``und`` with score 0.0. Labels that are null don't take part in training. A text
longer than a slice is scored whole. Ties between labels go to the first in sorted order. Extra
columns are carried through (``predict``) and may have any name but the two added ones, which
are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergate.llm.frames import arrow_map

DIM = 1 << 16
MAX_TRAIN = 6000
ORDERS = (1, 2, 3)
SCALE = 30.0  # n-gram shares are about 1/100; this brings gradients to the scale of the penalties
_LETTER = re.compile(r"[^\W\d_]")
_K = [np.uint32(k) for k in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_SLICE = 1 << 19


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray  # labels x (DIM + 1), IDF and temperature included, the last column zero
    bias: np.ndarray
    temperature: float


def _slices(texts: list[str | None]):
    """Rows (low, high) with their code points and offsets, about ``_SLICE`` characters each."""
    low, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append((t or "").lower())
        size += len(held[-1])
        if size >= _SLICE or i + 1 == len(texts):
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            yield low, i + 1, np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32), offsets
            low, held, size = i + 1, [], 0


def _features(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Feature of the n-gram of one order that starts at each place; ``DIM`` where the row has none."""
    out = np.full(len(codes), DIM, np.uint32)
    n = len(codes) - order + 1
    if n <= 0:
        return out
    h = np.full(n, order * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
    for j in range(order):
        h = (h ^ codes[j : j + n]) * _K[j]
        h ^= h >> np.uint32(15)
    out[:n] = h & np.uint32(DIM - 1)
    for j in range(1, order):  # n-grams that would reach into the next row
        ends = offsets[1:] - j
        out[ends[ends >= offsets[:-1]]] = DIM
    return out


def _grams(lengths: np.ndarray) -> np.ndarray:
    """n-grams of all orders in texts of these lengths."""
    return sum(np.maximum(lengths - k + 1, 0) for k in ORDERS)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of one text and their shares of its n-grams."""
    _, _, codes, offsets = next(_slices([text]))
    grams = np.concatenate([_features(codes, offsets, k) for k in ORDERS])
    grams = grams[grams < DIM]
    ids, n = np.unique(grams, return_counts=True)
    return ids, n / max(1, len(grams))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, over all of ``docs``; and their number."""

    def count(batches):
        total, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    _, _, codes, offsets = next(_slices([t]))
                    seen = np.zeros(DIM + 1, bool)
                    for k in ORDERS:
                        seen[_features(codes, offsets, k)] = True
                    total += seen[:DIM]
                    n += 1
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"f": np.append(ids, -1), "n": np.append(total[ids], n)})

    rows = arrow_map(docs.select(text), count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIM, np.int64)
    f, n = rows["f"].to_numpy(), rows["n"].to_numpy()
    df[f[f >= 0]] = n[f >= 0]
    return df, int(n[f < 0].sum())


def ftrl(samples, labels: np.ndarray, n_labels: int, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0,
         l1: float = 0.01, l2: float = 0.01, block: int = 32, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weights (DIM x labels) and bias by FTRL-proximal with an elastic net, in blocks of samples."""
    z, n = np.zeros((DIM + 1, n_labels)), np.zeros((DIM + 1, n_labels))

    def weights(ids):
        zz = z[ids]
        w = -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[ids])) / alpha + l2)
        return np.where(np.abs(zz) > l1, w, 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for low in range(0, len(order), block):
            part = order[low : low + block]
            ids, back = np.unique(np.concatenate([samples[i][0] for i in part]), return_inverse=True)
            ids = np.append(ids, DIM)  # the bias
            w = weights(ids)
            row = np.repeat(np.arange(len(part)), [len(samples[i][0]) for i in part])
            x = np.concatenate([samples[i][1] for i in part])
            scores = np.zeros((len(part), n_labels)) + w[-1]
            np.add.at(scores, row, w[back] * x[:, None])
            p = np.exp(scores - scores.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            g = np.zeros((len(ids), n_labels))
            np.add.at(g, back, p[row] * x[:, None])
            g[-1] = p.sum(0)
            g /= len(part)
            step = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - step * w
            n[ids] += g * g
    all_ = weights(np.arange(DIM + 1))
    return all_[:DIM], all_[DIM]


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on samples kept from training (golden-section search)."""

    def loss(log_t):
        s = scores / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), labels]).mean())

    low, high, r = np.log(0.02), np.log(50.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", max_train: int = MAX_TRAIN) -> Model:
    """Learn from the labelled rows of ``docs``."""
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"),
        F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string")).alias("h"))
    df, total = document_frequencies(labelled)
    share = F.lit(int(2**40 * min(1.0, max_train / max(1, total))))
    # rows that repeat an id and text are one; tasks drop most of them before the shuffle
    rows = labelled.where(F.pmod("h", F.lit(2**40)) < share).groupBy("h").agg(F.min(F.struct("label", "text")).alias("row")).select("row.text", "row.label", "h")

    # Distinct features of the sampled rows, made where the rows are; texts don't come to the driver.
    def sample(batches):
        for batch in batches:
            for t, y, h in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids, share = _counts(t)
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array([h], pa.int64()), "label": pa.array([y], pa.string()),
                    "ids": pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
                    "share": pa.array([share.astype(np.float32).tobytes()], pa.binary())})

    got = arrow_map(rows, sample, "h long, label string, ids binary, share binary").toArrow()
    got = got.sort_by([("h", "ascending"), ("ids", "ascending")])
    labels = sorted(set(got["label"].to_pylist()))
    if not labels:
        return Model((), np.zeros((0, DIM + 1), np.float32), np.zeros(0), 1.0)
    y = np.array([labels.index(x) for x in got["label"].to_pylist()])
    idf = SCALE * (np.log((1 + total) / (1 + df)) + 1)
    samples = []
    for ids, share in zip(got["ids"].to_pylist(), got["share"].to_pylist(), strict=True):
        ids = np.frombuffer(ids, np.int32)
        samples.append((ids, np.frombuffer(share, np.float32) * idf[ids]))
    held = np.arange(len(samples)) % 5 == 4
    train = [s for s, h in zip(samples, held, strict=True) if not h]
    w, bias = ftrl(train, y[~held], len(labels))
    scores = np.array([(w[i] * x[:, None]).sum(0) + bias for (i, x), h in zip(samples, held, strict=True) if h])
    t = _temperature(scores, y[held]) if len(scores) else 1.0
    return Model(tuple(labels), np.concatenate([(w * idf[:, None] / t).T, np.zeros((len(labels), 1))], 1).astype(np.float32), bias / t, t)


def score_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Label and probability of each text."""
    n, c = len(texts), len(model.labels)
    out = np.zeros((n, max(1, c)))
    for low, high, codes, offsets in _slices(texts):
        features = [_features(codes, offsets, k) for k in ORDERS]
        grams = np.maximum(_grams(np.diff(offsets)), 1)
        for j in range(c):
            w = model.weights[j]
            values = w[features[0]]
            for f in features[1:]:
                values += w[f]
            out[low:high, j] = _row_sums(values, offsets) / grams
    if not c:
        return ["und"] * n, np.zeros(n)
    out += model.bias
    out = np.exp(out - out.max(1, keepdims=True))
    out /= out.sum(1, keepdims=True)
    best, score = out.argmax(1), out.max(1)
    letters = np.array([bool(t) and _LETTER.search(t) is not None for t in texts], bool)
    return [model.labels[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` for every row."""
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            label, score = score_texts(shared.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(label, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return arrow_map(docs, run, schema)
