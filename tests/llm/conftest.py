import pytest


@pytest.fixture()
def documents(spark):
    """Rows -> a table like ``documents`` with a clashing extra column."""

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, value string").repartition(3)

    return make
