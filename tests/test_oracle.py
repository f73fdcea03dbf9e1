"""Every query beside its DuckDB text at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    assert oracle.compare(spark, db, FOLDER, name, contract.queries()[name], contract.oracle_sql().get(name)) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["domain", "n"]
