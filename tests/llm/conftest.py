from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) pairs, with columns that clash with names used
    inside the operators."""
    def make(rows, lang="en"):
        schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
                  "digest string, keep_id string, `odd.name` int")
        return spark.createDataFrame(
            [(k, t, lang, f"s{(k or 0) % 3}", len(t or ""), "x", "y", 1) for k, t in rows], schema)
    return make
