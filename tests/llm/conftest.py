import pytest


@pytest.fixture
def docs(spark):
    """Documents by (doc_id, text), with the other columns of the table and one that clashes."""

    def make(rows):
        full = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), -1.0) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
        return spark.createDataFrame(full, schema)

    return make
