import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text) rows, with the columns of the given table and one that could clash."""

    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)
        if extra:
            for name in ("row", "kept", "n_words", "did", "rate", "a", "n"):
                df = df.selectExpr("*", f"'mine' as {name}")
        return df

    return make


@pytest.fixture()
def prose():
    """Different words on every call with another seed, in sentences of twelve."""
    import random

    def make(n, seed):
        r = random.Random(seed)
        words = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n)]
        return " ".join(w + ("." if k % 12 == 11 else "") for k, w in enumerate(words))

    return make
