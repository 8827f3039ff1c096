import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a") for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCUMENTS)

    return make
