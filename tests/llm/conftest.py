import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Words for texts that do not repeat by chance.
SYLLABLES = ["ka", "lo", "mi", "ner", "tus", "ver", "pol", "dra", "sen", "qui", "bor", "fel"]


def words(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture
def documents(spark):
    """Frame of documents from (doc_id, text[, lang]) rows."""

    def make(rows):
        full = [(i, t, more[0] if more else "en", None, None if t is None else len(t)) for i, t, *more in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        for name in ("digest", "key", "n", "cid", "unit", "k1", "k2", "row", "label", "score", "size", "item", "hash", "kept", "best"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("clash"))
        return df

    return add
