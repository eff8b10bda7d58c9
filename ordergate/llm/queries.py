"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergate.llm import flat, language, pieces, pii
from ordergate.llm.copies import exact_duplicates
from ordergate.llm.divergence import source_divergence
from ordergate.llm.near import near_duplicates
from ordergate.llm.packing import pack
from ordergate.llm.passages import near_passages
from ordergate.llm.suffix import stripped
from ordergate.llm.vectors import approximate_top_k, exact_top_k
from ordergate.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op5_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximate_top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, a checksum of the ids, and whether decoding gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return docs.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), F.crc32(ids.cast("binary")).alias("ids_crc32"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files made of the documents."""
    blocks = flat.flat_blocks(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), separator=flat.SEPARATOR)
    return flat.token_counts(blocks, separator=flat.SEPARATOR).select("doc_id", "n_tokens")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(_table(spark, sf_dir, "documents"), min_words=50, percent=80)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.spans(docs, pii.fit(docs))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit(docs.where(~held).select("doc_id", "text", "lang"))
    found = language.predict(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripped(_table(spark, sf_dir, "documents"), length=400)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=16)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"), min_docs=30, top=50)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_threshold_top_k": op3_threshold_top_k,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_graph_neighbours": op5_graph_neighbours,
    "op6_token_counts": op6_token_counts,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_pii": op8_pii,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_language_id": op10_language_id,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_divergence": op13_source_divergence,
}
SQL: dict[str, str] = {
    "op2_near_duplicates": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
t AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT t.y, c.r FROM c JOIN t ON c.doc_id = t.x)
SELECT c.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id, c.doc_id = min(r) AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id GROUP BY c.doc_id""",
    "op3_threshold_top_k": """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS z FROM embeddings WHERE embedding IS NOT NULL),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.z, c.z) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
v AS (SELECT d.lang, count(DISTINCT k.term) AS v FROM d LEFT JOIN k ON k.lang = d.lang GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (
  SELECT e.lang, e.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) e LEFT JOIN c ON c.lang = e.lang AND c.source = e.source GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v.v) AS BIGINT) AS p
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (
  SELECT n.lang, n.term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n.n + 5)) // (t.total + 5 * v.v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) n JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY 1) t ON t.lang = n.lang
  JOIN v ON v.lang = n.lang),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - l.q FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q),
o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50""",
}
