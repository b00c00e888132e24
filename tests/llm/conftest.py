from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table with a clashing extra column from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1.0, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string")

    return make
