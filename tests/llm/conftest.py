import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) with lang, source, n_chars and a column whose name clashes with an operator's own."""

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, ord string"
        )

    return build
