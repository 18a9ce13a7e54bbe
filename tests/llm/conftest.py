import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents-like table with extra columns whose names clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", 0, 7, "x", 1.0) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, id long, key string, score double")
    return make
