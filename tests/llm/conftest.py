import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, tokens int, digest string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source[, lang]]), with further columns whose names operators use inside."""

    def build(rows, parts=3):
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, *["a", "en"][len(row) - 2 :])[:4]
            full.append((doc_id, text, lang, source, len(text) if text else None, "x", 1, "y"))
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


@pytest.fixture(scope="session")
def prose():
    """Random prose: ``prose(seed, words)``."""

    def make(seed, words, vocabulary=5000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))

    return make


@pytest.fixture
def awkward(prose):
    """Null, empty, blank, tiny and very long texts, repeated rows, a null id and a null source."""
    long = prose(99, 60_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, long),
        (6, prose(6, 80)),
        (6, prose(6, 80)),
        (7, prose(6, 80)),
        (8, "É ñ 中文 \U0001f600 x\x85y"),
        (9, prose(9, 90), None),
        (None, prose(10, 70)),
        (11, "12 34 !! ??"),
    ]
