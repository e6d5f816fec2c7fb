"""Each query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module
from orderflow.catalog import QUERIES
from orderflow.oracle import oracle_queries
from tools.check_oracles import database_of, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    return database_of(FOLDER)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = entry_module.queries()[name](spark, FOLDER).toArrow()
    assert difference(found, database, entry_module.oracle_sql()[name]) == ""


def test_expected_values(spark):
    found = entry_module.queries()["kpis"](spark, FOLDER).first()
    assert tuple(found) == (6000, 2070, 1968, 104769093.21)
    found = entry_module.queries()["event_kpis"](spark, FOLDER).first()
    assert tuple(found) == (1000, 202, 199, 21937.55)
