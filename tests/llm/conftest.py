from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table out of (doc_id, text) pairs or whole rows."""

    def make(rows, schema=DOCS):
        full = [tuple(r) + (None,) * (5 - len(r)) if schema == DOCS else r for r in rows]
        return spark.createDataFrame(full, schema)

    return make
