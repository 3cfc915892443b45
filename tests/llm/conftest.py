import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, ids=None, lang="en", source="s", extra=""):
    rows = [(i if ids is None else ids[i], t, lang, source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(7)
