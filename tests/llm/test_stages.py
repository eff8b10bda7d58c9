"""Stages of the pipeline against plain versions, and the bound of the classifier's sample."""

from collections import Counter

import corpus_pipeline as pipe
import pytest
from pyspark.sql import functions as F

from ordergate.llm import language


def plain_strip(texts, length):
    """Texts without the bytes of every string of ``length`` bytes that starts more than once; characters cut in two stay."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for t, r in zip(texts, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        if not any(gone):
            out.append(t)
            continue
        kept, at = [], 0
        for c in r.decode():
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


def test_suffix_stage(spark, corner_docs, prose):
    """A passage of 51 words goes from all texts that share it; texts of nothing else go; a column named as one inside does no harm."""
    passage = prose(51, 77)
    assert len(passage.encode()) >= pipe.PASSAGE_BYTES
    rows = [(900 + i, prose(80, 200 + i) + " " + passage + " " + prose(60, 300 + i)) for i in range(3)] + [(950, prose(90, 400))]
    more = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    docs = corner_docs.select(*pipe.COLUMNS).union(more).withColumns({"kept_text": F.lit("x"), "uid": F.lit(1)})
    before = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    want = Counter()
    for (d, t, lang, source, n), new in zip(before, plain_strip([r[1] for r in before], pipe.PASSAGE_BYTES), strict=True):
        if new is None or new == t:
            want[d, t, lang, source, n] += 1
        elif new.strip():
            want[d, new, lang, source, len(new)] += 1
    got = pipe.suffix_dedup(spark, docs, "").collect()
    assert Counter(tuple(r) for r in got) == want
    assert all(passage not in (r.text or "") for r in got) and any(r.doc_id == 950 for r in got)


@pytest.mark.parametrize("ids", ["null", "repeated", "own"])
def test_the_training_sample_is_bounded(spark, prose, monkeypatch, ids):
    """About ``max_train`` rows come to the driver also when all ids are null or one row is repeated."""
    taken = []
    real = language.ftrl
    monkeypatch.setattr(language, "ftrl", lambda samples, *a, **b: taken.append(len(samples)) or real(samples, *a, epochs=1))
    name = {"null": lambda i: None, "repeated": lambda i: 7, "own": lambda i: i}[ids]
    rows = [(name(i), "equal words of one text" if i % 3 == 0 else prose(8, i), "en" if i % 2 else "de") for i in range(1500)]
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_train=150)
    assert 30 <= taken[0] <= 160  # four fifths of the sample
