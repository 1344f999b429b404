"""Small tables for the operators' tests."""

from __future__ import annotations

import pytest

from pacefold.llm.queries import workers_find_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_find_package(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = [(*row, *(["en", "src0"][len(row) - 2 :])) for row in rows]
        full = [(*row, len(row[1] or "")) for row in full]
        return spark.createDataFrame(full, SCHEMA)

    return make
