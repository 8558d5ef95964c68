import pytest

from pyspark.sql import Row


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (doc_id counts from 0) or (doc_id, text) pairs, with columns whose names could clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, leaf long, word string"

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([Row(d, t, "en", None, None if t is None else len(t), "k", 1.5, 7, "w") for d, t in rows], schema)

    return make

