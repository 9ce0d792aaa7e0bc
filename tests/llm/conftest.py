from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with the columns of the documents table."""

    def make(rows, lang=None):
        return spark.createDataFrame(
            [(i, t, lang, None, None if t is None else len(t)) for i, t in rows], DOCS
        )

    return make
