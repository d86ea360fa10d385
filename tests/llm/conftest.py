import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASHING = ["n_words", "spans", "kept", "n_hit", "hits", "items", "contaminated", "longest", "component_id", "n_links", "whole_text"]


@pytest.fixture()
def documents(spark):
    """documents(rows of (doc_id, text)): a table with extra columns whose
    names the operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)

    return make
