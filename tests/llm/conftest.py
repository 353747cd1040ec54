import random

import pytest


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def vocabulary(rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def prose(rng, vocabulary):
    """prose(n): n random words, a few line breaks."""
    def make(n):
        return "".join(w + ("\n" if rng.random() < 0.05 else " ") for w in rng.choices(vocabulary, k=n)).strip()

    return make


@pytest.fixture(scope="session")
def odd_texts(prose):
    """Null, empty, white space only, short, very long, non-ASCII, control characters."""
    return [None, "", " \n\t ", "one", "a b c d", "x" * 30_000, prose(20_000), "é世界 ß\x0b\x0c\r\n\x85   z", "\\ < > # </turn>", "\n\n\n"]


def documents(spark, rows, extra=True):
    """rows: (doc_id, text[, source]) as a table with columns that clash with results."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    if not extra:
        return df
    from pyspark.sql import functions as F

    clash = {c: F.lit("clash") for c in ("node", "kept", "size", "score", "n_words", "_key", "label", "word", "line", "place", "bucket", "chunk", "keep_id", "copies")}
    return df.withColumns(clash)
