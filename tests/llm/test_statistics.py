"""Exact dedup, whitening and source divergence against plain versions, on corner cases and on the given tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from ordergate.llm import copies, divergence, whitening
from ordergate.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# exact duplicates

def plain_copies(docs):
    """Sorted (doc_id, keep_id, group_size, kept, digest) of (id, text) rows."""
    groups = defaultdict(list)
    for d, t in docs:
        groups[hashlib.sha256((t or "").translate(FOLD).encode()).hexdigest()].append(d)
    out = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = [True] + [False] * (len(ids) - 1)  # of several rows with the largest id one stays
        rest = list(ids)
        rest.remove(keep)
        out += [(d, keep, len(ids), k, digest) for d, k in zip([keep, *rest], stays, strict=True)]
    return Counter(out)


def copies_of(df, **more):
    return Counter(tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in copies.exact_duplicates(df, **more).collect())


@pytest.mark.parametrize("split", [{}, {"counters": 2, "heavy": 1}, {"counters": 40, "heavy": 39}])
def test_exact_duplicates(corner_docs, split):
    rows = [(r.doc_id, r.text) for r in corner_docs.select("doc_id", "text").collect()]
    assert copies_of(corner_docs, **split) == plain_copies(rows)


def test_exact_duplicates_letters(spark):
    texts = ["ÀB", "àb", "Àb", "İx", "i̇x", "KELVIN K", "kelvin k", "kelvin K", "", None, "A" * 300_000, "a" * 300_000, "Σς", "σς"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert copies_of(df) == plain_copies(list(enumerate(texts)))
    assert copies_of(df.limit(0)) == Counter()


def test_heavy_digests_are_split_off(spark):
    """A third of all rows has one text: it is found by the counters, and is no row of the shuffle."""
    rng = np.random.default_rng(2)
    rows = [(i, "same" if i % 3 == 0 else f"text {rng.integers(400)}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    digests = df.selectExpr("unhex(sha2(text, 256)) as digest")
    found = [r.digest for r in copies.heavy_digests(digests, 6000, counters=64, heavy=8).collect()]
    assert found == [hashlib.sha256(b"same").digest()]
    assert len(copies.heavy_digests(digests, 6000, counters=64, heavy=32).collect()) < 32 * 64 / 32
    assert copies_of(df, counters=64, heavy=8) == plain_copies(rows)


def test_misra_gries_bounds():
    rng = np.random.default_rng(3)
    values = [b"%d" % v for v in np.minimum(rng.zipf(1.3, 20000), 5000)]
    exact, batches = Counter(values), [pa.record_batch({"digest": pa.array(values[i : i + 700], pa.binary())}) for i in range(0, 20000, 700)]
    got = dict(zip(*copies.frequent(iter(batches), 50).to_pydict().values(), strict=True))
    assert len(got) <= 50
    assert all(exact[v] - 20000 / 50 <= got.get(v, 0) <= exact[v] for v in exact)


def test_without_copies_keeps_all_columns(corner_docs):
    rows = corner_docs.collect()
    got = copies.without_copies(corner_docs)
    assert got.schema == corner_docs.schema
    want = Counter(k[:1] + k[4:] for k in plain_copies([(r.doc_id, r.text) for r in rows]).elements() if k[3])
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").translate(FOLD).encode()).hexdigest()) for r in got.collect()) == want


# whitening

def checked_components(a, k):
    values, vectors = whitening.leading_components(a, k)
    want = np.linalg.eigvalsh(a)[::-1][: len(values)]
    size = np.abs(np.linalg.eigvalsh(a)).max()
    assert np.abs(values - want).max() <= 1e-13 * size * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * size * len(a)
    return values, vectors


@pytest.mark.parametrize("spectrum", [
    np.arange(1, 65.0), np.ones(40), np.repeat([9.0, 5, 5, 1], 8), np.geomspace(1, 1e-9, 30), np.concatenate([[3.0], np.full(20, 2.0) + np.arange(20) * 1e-13]),
    [7.0], [4.0, 4.0], [5.0, 1.0, 1.0],
])
def test_components_of_known_spectra(spectrum):
    d = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((d, d)))[0]
    a = (q * np.array(spectrum)) @ q.T
    checked_components((a + a.T) / 2, 16)
    checked_components(np.diag(np.array(spectrum, float)), 16)


def test_components_of_special_matrices():
    assert len(whitening.leading_components(np.zeros((5, 5)), 3)[0]) == 0
    x = np.random.default_rng(5).standard_normal((4, 30))
    values, _ = checked_components(x.T @ x, 16)
    assert len(values) == 4  # rank
    checked_components(np.diag(np.arange(30.0)) + np.diag(np.full(29, 1.0), 1) + np.diag(np.full(29, 1.0), -1), 16)
    checked_components(x.T @ x * 1e-12, 3)


def plain_whitening(rows, k):
    """(n, by row: deviation and absolute whitened values, explained) of (id, vector) rows."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(Counter(len(v) for _, v in good).items(), key=lambda p: (p[1], p[0]))[0]
    x = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in good if len(v) == size]
    fit = sorted({v for _, v in x})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, total, strict=True)] for v in fit])
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    out = []
    for i, v in x:
        own = np.array([float(Fraction(n * c - s, n)) for c, s in zip(v, total, strict=True)])
        out.append((i, sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)), np.abs(own @ q / np.sqrt(e))))
    return n, out, e / np.trace(cov)


def checked_whitening(df, rows, k=16):
    n, want, explained = plain_whitening(rows, k)
    got = whitening.whiten(df, k).collect()
    assert len({(r.n, r.identity_error) for r in got}) == 1 and got[0].n == n and got[0].identity_error < 1e-9
    by_row = Counter()
    for i, deviation, values in want:
        by_row.update((i, c + 1, deviation, round(float(v), 7)) for c, v in enumerate(values))
    assert Counter((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 7)) for r in got) == by_row
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in got)


def test_whitening_query(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    checked_whitening(df, [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()])
    got = QUERIES["op12_embedding_whitening"](spark, SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 16 * df.count()


def test_whitening_corners(spark, monkeypatch):
    """Nulls, numbers that aren't finite, other lengths, repeats, null ids, clashing columns; several rounds of partial sums."""
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    same = rows[3][1]
    rows += [(100 + i, same) for i in range(300)] + [(3, same), (None, same), (None, rng.standard_normal(5).tolist())]
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0]), (502, [1.0, float("nan"), 0.0, 0.0, 0.0]), (503, [float("inf")] * 5), (504, [1.0, 2.0]), (505, [])]
    df = spark.createDataFrame([(i, v, "x", 1, 0.5) for i, v in rows], "vec_id long, embedding array<double>, x string, n int, id double").repartition(9)
    checked_whitening(df, rows, 3)
    assert {r.vec_id for r in whitening.whiten(df).collect()}.isdisjoint(range(500, 506))


def test_whitening_without_directions(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, []), (2, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.75, 0.25])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in two) == [(1, 1, 2, 256, 1.0, 1.0), (2, 1, 2, 256, 1.0, 1.0)]


def test_whitening_large_numbers(spark):
    """Sums of squares that need more than 64 bits on the way, and one that doesn't fit a long."""
    big = 2.0**44
    rows = [(1, [0.0, 1.0]), (2, [0.0, 3.0]), (3, [big, 1.0]), (4, [-big, 2.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[3] is None and got[4] is None
    want = {i: d for i, d, _ in plain_whitening(rows, 2)[1]}
    assert (got[1], got[2]) == (want[1], want[2])


# source divergence

def plain_divergence(docs, min_docs, top):
    terms = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(FOLD))) for la, so, t in docs]
    in_docs, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for la, so, found in terms:
        in_docs[la].update(set(found))
        groups[la][so].update(found)
    out = set()
    for la, sources in groups.items():
        kept = sorted((t for t, n in in_docs[la].items() if n >= min_docs), key=str.encode)

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        p = {so: share(c) for so, c in sources.items()}
        q = share(sum(sources.values(), Counter()))
        for so in sources:
            pairs = sorted(((-sum(abs(p[so][t] - p[b][t]) for t in kept), b.encode(), b) for b in sources if b != so))
            own = sorted((q[t] - p[so][t], t.encode(), t) for t in kept if sources[so][t] and p[so][t] > q[t])[:top]
            out |= {(la, so, "pair", b, -v, i + 1) for i, (v, _, b) in enumerate(pairs)}
            out |= {(la, so, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(own)}
    return out


def divergence_of(df, **more):
    rows = divergence.source_divergence(df, **more).collect()
    got = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


def triples(df):
    return [(r.lang, r.source, r.text) for r in df.select("lang", "source", "text").collect()]


@pytest.mark.parametrize("min_docs", [1, 2, 5, 100])
def test_source_divergence_corners(corner_docs, min_docs):
    assert divergence_of(corner_docs, min_docs=min_docs, top=7) == plain_divergence(triples(corner_docs), min_docs, 7)


def test_source_divergence_in_many_shards(spark, monkeypatch):
    """The same whatever the sizes of slices, held tables and shards; ties, and letters of several bytes."""
    rng = np.random.default_rng(8)
    words = ["Éa", "éa", "ÉA", "z", "aa", "Ab", "ab", "ж", "日本", "\U0001f600x", "o'k", "9a9", "a-b"]
    rows = [(["en", "fr", None][rng.integers(3)], ["s1", "s2", "É", "", None][rng.integers(5)], " ".join(rng.choice(words, rng.integers(0, 30)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    want = plain_divergence(rows, 3, 4)
    assert divergence_of(df, min_docs=3, top=4) == want
    for name, value in (("SLICE", 50), ("HELD", 10), ("CELLS", 4)):
        monkeypatch.setattr(divergence, name, value)
    assert divergence_of(df, min_docs=3, top=4) == want
    assert divergence_of(df.limit(0)) == set()


def test_source_divergence_query(spark):
    got = {tuple(r) for r in QUERIES["op13_source_divergence"](spark, SMALL).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == plain_divergence(triples(spark.read.parquet(f"{SMALL}/documents.parquet")), 30, 50)


def test_shares_are_exact():
    rng = np.random.default_rng(9)
    totals = rng.integers(1, 9 * 10**15, 200)
    counts = (totals * rng.random(200)).astype(np.int64)
    assert divergence.shares(counts, totals).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(counts, totals, strict=True)]
