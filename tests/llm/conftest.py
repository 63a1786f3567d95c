import random

import pytest

WORDS = "alpha beta gamma delta omega sigma kappa theta lambda zeta rho tau".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns with the names of results."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = [None, "", " ", "x", "Ünï çödé 日本 🎉", "a\x00b\n\n c", prose(40), prose(40), prose(6000), "1 2 3", "don't we'll"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(6, texts[6], "en", "s"), (None, "no id here", None, None), (50, texts[6], "en", "s"), (51, texts[6] + " x", "en", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("score", "n_tokens", "token_ids", "n_bytes", "key", "id", "component", "words", "round_trip"):
        frame = frame.withColumn(name, frame["source"])
    return frame


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
