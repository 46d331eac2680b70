import pytest

from rinkframe.llm.registry import prepare


@pytest.fixture(scope="session")
def text_spark(spark):
    return prepare(spark)


@pytest.fixture
def documents(text_spark):
    """Make a frame of documents with columns whose names clash with inner ones."""
    def make(rows):
        schema = ("doc_id bigint, text string, id bigint, label string, posterior double, "
                  "code int, place string, gone string, `key` string")
        return text_spark.createDataFrame(
            [(i, t, 1, "x", 0.5, 2, "p", "g", "k") for i, t in rows], schema)
    return make
