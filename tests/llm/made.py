import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, other columns filled in."""
    def make(rows, extra=None):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns(extra) if extra else df
    return make
