import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs, with columns whose names clash with the operators' own."""
    def make(rows):
        full = [(i, x, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", None if x is None else len(x)) for i, x in rows]
        df = spark.createDataFrame(full, DOCS)
        return (df.selectExpr("*", "7 AS fp", "'x' AS digest", "1 AS v", "true AS kept", "'y' AS spans", "0.5D AS weight",
                              "'z' AS s", "1L AS tokens", "1 AS ids"))
    return make


@pytest.fixture
def words():
    """Reproducible invented words."""
    import random

    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def make(n):
        return ["".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(n)]
    return make
