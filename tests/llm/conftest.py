import pytest


@pytest.fixture
def docs_of(spark):
    """Builds a documents table with extra columns whose names clash with inner ones."""

    def make(rows):
        rows = [(i, t, "x", 7, 1) for i, t in rows]
        schema = "doc_id long, text string, node string, row int, n_tokens int"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}"
