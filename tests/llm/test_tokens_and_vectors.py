"""SentencePiece, token counts, vector searches and the pipeline against plain versions."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto
from pyspark.sql import functions as F

import corpus_pipeline
from ordergate.llm import flat, pieces, queries, vectors

SMALL = "/root/testdata/sf0.001"
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram():
    """The public library in unigram mode, with the scores the operator reads from the file."""
    model = proto.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    for p, s in zip(model.pieces, pieces.piece_scores(model)):
        if p.type == 1:
            p.score = float(s)
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor()
    library.LoadFromSerializedProto(model.SerializeToString())
    return library


def test_encoding_equals_the_library(spark, unigram, prose):
    texts = ["Hello  world   the   thing 你好☃ \n\n x", " ", "  a", "😀😀 é", "", "a" * 300, "caf́e", *prose(200, 3).split()[:100]]
    texts += [t for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(40).collect() for t in r["text"].split("\n")[:2]]
    got = [np.frombuffer(x, "<i4").tolist() for x in pieces.pieces_of(PIECES).encode(texts)]
    want = [unigram.encode(t) for t in texts]
    # the library sums over whole texts in single precision, so that long texts may break ties otherwise
    assert [g for g, t in zip(got, texts) if len(t) < 60] == [w for w, t in zip(want, texts) if len(t) < 60]
    scores = [unigram.GetScore(i) if not unigram.IsByte(i) else 0 for i in range(unigram.GetPieceSize())]
    assert [sum(scores[i] for i in g) for g in got] == pytest.approx([sum(scores[i] for i in w) for w in want], rel=1e-5)


def test_chunks_of_unlike_lengths_are_segmented_together(unigram):
    chunks = ["▁the", "▁☃thing", "▁", "▁" + "ab" * 50, "▁你好", "▁the", "▁\ue123\ue123x"]
    got = [np.frombuffer(x, "<i4").tolist() for x in pieces.pieces_of(PIECES)._segment(chunks)]
    assert got == [unigram.encode(c[1:]) if c != "▁" else [unigram.piece_to_id(c)] for c in chunks]


def test_round_trip(corner_docs):
    there = pieces.decode(pieces.encode(corner_docs, PIECES), PIECES)
    assert there.where("not (decoded <=> text)").count() == 0 and there.where("text is null and ids is null").count() == 2
    assert there.columns == [*corner_docs.columns, "ids", "decoded"]


@pytest.mark.parametrize("size", [8, 64, 1 << 20])
def test_flat_counts(spark, corner_docs, size):
    from tokenizers import Tokenizer

    docs = corner_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    blocks = flat.flat_blocks(docs, WORDS, 49407, size)
    got = {r["doc_id"]: r["n_tokens"] for r in flat.token_counts(blocks, 49407).collect()}
    tokenizer = Tokenizer.from_file(WORDS)
    assert got == {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}


def test_flat_counts_of_texts_with_the_end_mark(spark, tmp_path):
    """A text may hold the letters of a special token."""
    from tokenizers import Tokenizer

    texts = ["a<|endoftext|>b", "<|endoftext|>", "plain words", "<|startoftext|> x <|endoftext|> <|endoftext|>", "", None, "last"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in queries.op6_token_counts(spark, str(tmp_path)).collect())
    tokenizer = Tokenizer.from_file(WORDS)
    assert got == [(i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    with pytest.raises(Exception, match="is the separator"):
        flat.flat_blocks(spark.createDataFrame([(1, "<|endoftext|>")], "doc_id long, text string"), WORDS, 49407).collect()


def test_flat_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flat, "LEVEL", 3)
    rng = np.random.default_rng(0)
    files = {"a": np.where(rng.random(5000) < 0.01, 0, 5), "b": np.array([7] * 100), "c": np.array([0, 0, 3, 0]), "d": np.zeros(0, int)}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype("<u4").tobytes())
    got = {}
    for r in flat.token_counts(flat.flat_files(spark, str(tmp_path), 64), 0, 4).orderBy("file", "start").collect():
        got.setdefault(r["file"][-1], []).append((r["start"], r["n_tokens"], r["closed"]))
    for name, ids in files.items():
        want, start = [], 0
        for at in np.flatnonzero(ids == 0):
            want.append((start, at - start, True))
            start = at + 1
        want += [(start, len(ids) - start, False)] if start < len(ids) else []
        assert got.get(name, []) == want


def vector_frame(spark, n=700, d=16):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, d))
    x[100:160] = x[100]  # copies
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(None, rows[0][1]), (9001, None), (9002, [None] * d), (9003, [float("nan")] + [0.0] * (d - 1)), (9004, [1.0]), (9020, [0.0] * d), (9040, [float("inf")] * d)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id long, embedding array<double>, v string, shard int"), x


def plain_top(ids, x, queries, k):
    out = {}
    for q in queries:
        s = np.einsum("cd,d->c", x, x[list(ids).index(q)])
        out[q] = [(ids[i], s[i]) for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
    return out


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 150)
    monkeypatch.setattr(vectors, "BLOCK", 10)
    frame, x = vector_frame(spark)
    got = {}
    for r in vectors.exact_top_k(frame, F.col("id") % 20 == 0, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids = [*range(700), 9020]
    whole = np.vstack([np.floor(64 * x), np.zeros(x.shape[1])]).astype(int)
    assert got == plain_top(ids, whole, [i for i in ids if i % 20 == 0], 7)


def test_threshold_stops_early():
    """A dimension that decides: few rows may be scored, and the result must still be right."""
    rng = np.random.default_rng(0)
    rows = rng.integers(-3, 4, (2000, 2))
    rows[:50, 0] += 500
    (_, found, _, scored), = vectors.threshold_search(np.array([-1]), np.array([[3, 1]]), np.arange(2000), rows, 5)
    s = rows @ np.array([3, 1])
    assert found.tolist() == np.lexsort((np.arange(2000), -s))[:5].tolist()
    assert scored < 50


def test_threshold_chooses_again_only_among_better_rows(monkeypatch):
    calls, top = [], vectors._top
    monkeypatch.setattr(vectors, "_top", lambda *x: calls.append(1) or top(*x))
    rows = np.floor(64 * np.random.default_rng(4).normal(size=(4000, 16)) / 4).astype(np.int64)
    query, depths = rows[0], 10  # 8, 16, ... 4000
    (_, found, best, scored), = vectors.threshold_search(np.array([-1]), query[None], np.arange(4000), rows, 5)
    scores = rows @ query
    want = np.lexsort((np.arange(4000), -scores))[:5]
    assert found.tolist() == want.tolist() and best.tolist() == scores[want].tolist()
    assert scored > 3000 and len(calls) < depths - 2


@pytest.mark.parametrize("scale", [1, 1 << 30])
def test_threshold_reads_lists_to_the_end(scale):
    """Ties, repeated rows and ids, queries with zeros or only zeros, fewer rows than k, products beyond 53 and 64 bits: always the plain result."""
    rng = np.random.default_rng(3)
    for n, d, k in ((1, 3, 5), (7, 2, 7), (40, 5, 3), (900, 8, 20)):
        rows = rng.integers(-2, 3, (n, d)) * scale
        ids = rng.integers(0, n, n)
        queries = np.concatenate([rows[:6], np.zeros((1, d), int), rng.integers(-1, 2, (5, d)) * (scale * 3)])
        query_ids = np.arange(len(queries))
        for at, found, best, scored in vectors.threshold_search(query_ids, queries, ids, rows, k):
            s = rows @ queries[at]
            want = [i for i in np.lexsort((-ids, s))[::-1] if ids[i] != at][:k]
            assert list(zip(found.tolist(), best.astype(np.int64).tolist())) == [(ids[i], s[i]) for i in want]
            assert scored <= n


def test_graph_recall(spark, monkeypatch):
    monkeypatch.setattr(vectors, "GRAPH_SHARD", 300)
    frame, x = vector_frame(spark)
    got = {}
    for r in vectors.approximate_top_k(frame, F.col("id") % 20 == 0, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = plain_top(list(range(700)), x, range(0, 700, 20), 10)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([float(x[q] @ x[i]) for i, _ in found])


def test_no_vectors(spark):
    frame, _ = vector_frame(spark)
    none = frame.where("false")
    assert vectors.exact_top_k(none, F.col("id") >= 0).count() == 0 and vectors.approximate_top_k(none, F.col("id") >= 0).count() == 0


def test_pipeline_stages(spark, corner_docs, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(corner_docs.select(*corpus_pipeline.COLUMNS).withColumn("doc_id", F.col("doc_id") + 100000))
    counts = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if n < 4:
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] == counts[3] <= counts[4]
    clean = spark.read.parquet(str(tmp_path / "pii"))
    assert clean.where("text rlike '[A-Za-z0-9]@[A-Za-z0-9]+[.]'").count() == 0 and clean.where("n_chars <> char_length(text)").count() == 0


def test_pipeline_keeps_one_copy(spark, prose, tmp_path):
    """Repeated rows, null ids and repeated ids: one row of each group reaches packing, and unique texts under a repeated id stay."""
    twice, null, mixed, unique, other = (prose(150, 400 + i) for i in range(5))
    rows = [(1, twice), (1, twice), (None, null), (None, null), (None, null), (None, mixed), (7, mixed), (3, mixed), (3, unique), (7, other), (None, None), (None, None), (8, " "), (8, " ")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(1, twice), (0, null), (3, mixed), (3, unique), (7, other), (0, ""), (0, ""), (8, " "), (8, " ")])
    kept.write.parquet(str(tmp_path / "kept"))
    docs = spark.read.parquet(str(tmp_path / "kept"))
    stripped = corpus_pipeline.suffix_dedup(spark, docs, SMALL)
    assert sorted(r["text"] for r in stripped.where("text rlike '[a-z]'").collect()) == sorted([twice, null, mixed, unique, other])
    packed = corpus_pipeline.packing(spark, stripped.where("text rlike '[a-z]'"), SMALL)
    assert sorted((r["doc_id"] or 0) for r in packed.where("piece = 0").collect()) == [0, 1, 3, 3, 7]


def test_pipeline_of_nothing(spark, corner_docs):
    none = corner_docs.select(*corpus_pipeline.COLUMNS).where("false")
    assert [stage(spark, none, SMALL).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5
