import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, written and read again as a query would."""
    from tripstream.llm.common import ready, written

    ready(spark)

    def make(rows, parts=3):
        df = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        return written(df.repartition(parts) if rows else df, "fixture")

    return make


@pytest.fixture(scope="session")
def clashing():
    """The same frame with extra columns whose names clash with inner ones."""
    def add(df):
        names = ["t", "r", "d", "n", "g", "row", "key", "gone", "lines", "w", "at", "hash", "first", "k", "bin", "piece"]
        return df.withColumns({n: F.lit(f"x-{n}") for n in names if n not in df.columns})

    return add


# Null, empty, blank, one word, ties, repeated rows, and a long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f g"), (5, "a b c d e f g"),
       (6, "a b c d e f g"), (None, "a b c d e f g"), (None, None),
       (7, "\n".join(" ".join(f"w{i * 7 + j}" for j in range(60)) for i in range(400)))]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
