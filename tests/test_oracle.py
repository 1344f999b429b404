"""Every registered query against its SQL on whole tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from compare import connect, oracle_rows, spark_rows
from pacefold.plans.oracle import oracle
from pacefold.plans.queries import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry()
ORACLE = oracle()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_driver_registers_them_all():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(duck, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


@pytest.mark.parametrize("missing", ["sentencepiece", "corpus_pipeline", "pacefold.llm"])
def test_entry_without_the_text_operators(missing):
    """A library of theirs, or they themselves, may be absent."""
    code = (
        f"import sys, warnings; sys.modules[{missing!r}] = None; warnings.simplefilter('ignore'); "
        "import __spark_entry__ as d; print(len(d.queries()), len(d.oracle_sql()))"
    )
    root = Path(driver.__file__).parent
    found = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(QUERIES))] * 2
