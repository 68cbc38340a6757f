from __future__ import annotations

import pytest

from orderlens.llm import workers


@pytest.fixture(scope="session")
def session(spark):
    workers.prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs(session):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one that clashes with results."""

    def build(rows, lang="en", source="s"):
        full = [(i, t, lang, source, len(t or ""), "kept") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string"
        return session.createDataFrame(full, schema)

    return build
