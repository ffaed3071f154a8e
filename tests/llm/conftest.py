import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, weight double"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]), with extra columns whose names operators use too."""

    def make(rows):
        full = [(i, t, "en", (s or ["a"])[0], len(t or ""), 5, "k", 0.5) for i, t, *s in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return make
