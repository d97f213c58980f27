from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs."""

    def made(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return made


#: Columns that operators use for themselves, as extra columns of a table.
CLASHES = ("row", "id", "text_", "score", "fp", "drops", "key", "spans_", "words", "block", "bucket", "host", "page", "n_dropped_")


@pytest.fixture(scope="session")
def clashing():
    def made(frame):
        return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHES})

    return made
