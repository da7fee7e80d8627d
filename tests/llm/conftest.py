import pytest


@pytest.fixture
def documents(spark):
    """Rows with nulls, repeats, ties, an empty text, and further columns with clashing names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, text_hash string, kept string"
        return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", "x", "y") for i, t in rows], schema)

    return make
