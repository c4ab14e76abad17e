import pytest


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) rows, with columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 7) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, _drop string, fp long")

    return make
