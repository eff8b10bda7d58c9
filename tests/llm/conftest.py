import random

import pytest

EXTRA = "uid long, id long, body string, score double, spans string, base string, band long"


@pytest.fixture(scope="session")
def prose():
    """Invented words, the same on every run."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["ka", "lo", "mi", "tu", "re", "sa", "no"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    return lambda n, seed: " ".join(random.Random(seed).choices(vocabulary, k=n))


@pytest.fixture(scope="session")
def corner_docs(spark, prose):
    """Nulls, empty and very long texts, repeated rows and copies, ties, and columns with names the operators use inside."""
    passage = prose(140, 1)
    texts = [
        None, "", " \n\t ", "one", "Two words", passage, passage, prose(60, 2) + " " + passage + " " + prose(70, 3),
        prose(30000, 4), "12345 67890 !!!", passage.upper(), "é" * 500, "é" * 499 + "è", "x" * 900, prose(200, 6) + " a@b.co +1 (017) 555-7713 or 4111111111111111 or 10.0.0.1",
    ]
    edited = prose(200, 6).split()
    edited[100] = "changed"
    texts.append(" ".join(edited))
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, passage, None, None, None), (None, None, None, None, None)]
    junk = (7, 7, "junk", 0.5, "junk", "junk", 7)
    return spark.createDataFrame([(*r, *junk) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)
