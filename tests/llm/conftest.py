import pytest
from pyspark.sql import functions as F

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or (id, text) pairs, with columns whose names clash with the operators' own."""

    def make(*texts, clash=True):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DDL)
        if clash:
            for name in ("recipe", "kept", "h", "_id", "_leaks", "score", "sid", "m", "length", "row", "label"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DDL)
