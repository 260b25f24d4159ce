import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture
def docs(spark):
    """A documents frame (doc_id, text, source) of texts, numbered, or of rows."""

    def make(rows):
        full = [r if isinstance(r, tuple) else (i, r, f"s{i % 3}") for i, r in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id bigint, text string, source string")

    return make
