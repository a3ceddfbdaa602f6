from __future__ import annotations

import pytest

from marketfold.llm.common import prepare


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    prepare(spark)


@pytest.fixture
def docs(spark):
    """Builds documents from (id, text) pairs, with columns whose names the operators use inside."""

    def build(pairs):
        schema = """doc_id long, text string, id string, row string, node int, words int, key string,
            spans string, lost_id int, lost_hash int, left_text string, text_hash int, n int"""
        extra = ("x", "y", 7, 8, "z", "s", 1, 2, "l", 3, 4)
        return spark.createDataFrame([(i, t, *extra) for i, t in pairs], schema)

    return build
