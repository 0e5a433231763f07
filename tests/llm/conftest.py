import pytest


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text), with further columns whose names helpers also use."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, score int")
    return make
