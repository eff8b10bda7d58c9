"""A corpus from raw documents to packed training sequences.

``STAGES`` are functions of (spark, docs, sf_dir) that return a DataFrame; each is written as Parquet
and read again for the next. All but the last return the columns of ``documents``.

1. ``language_id``: documents without letters, and those whose language the model is less sure of than
   ``MIN_SCORE``, go.
2. ``near_dedup``: of each group linked by five-word shingles at similarity 0.8, the row with the smallest id stays, null ids last. Rows are told apart
   by id and text, so null ids and repeated ids are linked too; of equal rows one stays. Texts without words all stay.
3. ``suffix_dedup``: every string of ``PASSAGE_BYTES`` bytes that starts more than once loses its bytes; documents of which nothing but
   white space is left go. 99 in 100 passages of more than 50 words are as long as that.
4. ``pii``: personal data becomes ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``.
5. ``packing``: what is left, cut and packed into sequences of 2048 tokens.

Stages drop columns that ``documents`` lacks. Null ids and nulls in other columns pass through; a null text has no letters and goes in the first stage. The
classifier learns from the labelled documents of its own input that are not held out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordergate.llm import language, pii
from ordergate.llm.frames import Scratch
from ordergate.llm.near import near_duplicates
from ordergate.llm.packing import pack
from ordergate.llm.suffix import repeated_strings, row_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.5
PASSAGE_BYTES = 240


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = language.fit(docs.where(~held))
    scored = language.predict(docs.select(*COLUMNS), model)
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(worded).withColumn("uid", row_key())
    groups = near_duplicates(rows, size=5, percent=80, id_="uid").select(F.col("doc_id").alias("uid"), "component_id").distinct()
    ids = rows.select("uid", F.col("doc_id").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "uid")).getField("uid")
    stays = groups.join(ids, "uid").groupBy("component_id").agg(first.alias("uid")).select("uid")
    # equal rows differ in the other columns at most
    number = F.row_number().over(Window.partitionBy("uid").orderBy("lang", "source", "n_chars"))
    kept = rows.join(stays, "uid", "left_semi").withColumn("number", number).where("number = 1")
    return kept.select(*COLUMNS).union(docs.where(~worded).select(*COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    lost = repeated_strings(docs, PASSAGE_BYTES).select("uid", "kept_text")
    left = docs.withColumn("uid", row_key()).join(lost, "uid", "left").where("kept_text is null or kept_text rlike '\\\\S'")
    text = F.coalesce("kept_text", "text")
    return left.withColumns({"text": text, "n_chars": F.when(F.col("kept_text").isNull(), F.col("n_chars")).otherwise(F.char_length("kept_text"))}).select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs.select(*COLUMNS, F.col("text").alias("before")), pii.fit(docs))
    changed = ~F.col("text").eqNullSafe(F.col("before"))
    return clean.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("pii", redact_pii),
    ("packing", packing),
]
#: No stage but the redaction can be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
