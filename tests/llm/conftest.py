import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns named like results
    T.StructField("items", T.StringType()), T.StructField("rank", T.LongType()), T.StructField("evidence", T.StringType())])


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) tuples."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 7, None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    import random
    rng = random.Random(3)
    long_text = sentence(rng, 60_000)
    base = sentence(rng, 120)
    return [(1, None), (2, ""), (3, "  \n\t "), (4, base), (5, base), (5, base), (6, base + " tail end"), (None, base),
            (None, "only without id"), (7, long_text), (8, long_text + " more"), (9, "x"), (10, "x"), (11, "a" * 300_000)]
