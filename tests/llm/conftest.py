from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (ids count up), or from (id, text) pairs."""
    def make(texts, source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in rows], DOCS)

    return make
