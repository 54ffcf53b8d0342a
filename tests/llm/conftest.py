from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text, lang, source)."""

    def make(rows):
        full = []
        for k, row in enumerate(rows):
            doc_id, text, lang, source = (k, row, "en", "a") if not isinstance(row, tuple) else row
            full.append((doc_id, text, lang, source, len(text or "")))
        return spark.createDataFrame(full, SCHEMA)

    return make
