"""Small tables that hold every edge case, and their brute-force answers' helpers."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, print string"


@pytest.fixture
def documents(spark):
    """Builds documents with extra columns whose names clash with internal ones."""

    def build(rows):
        full = [(i, t, lang, src, None if t is None else len(t), 0.5, "p") for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
