import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, lang[, source]]) -> a documents table."""
    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)
    return make
