import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts (ids count from 0) or (id, text) pairs."""

    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, None, "src", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENT)

    return make
