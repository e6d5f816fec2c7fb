"""Each corpus query with SQL against it, and what the driver is given."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from orderflow.llm.oracles import ORACLES
from orderflow.llm.queries import QUERIES
from tools.check_oracles import database_of, difference

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.mark.parametrize("folder", [f for f in FOLDERS if Path(f).exists()])
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name, folder):
    found = QUERIES[name](spark, folder).toArrow()
    assert difference(found, database_of(folder), ORACLES[name]) == ""


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry_module.queries())
    for number in range(1, 14):
        assert [n for n in names if n.startswith(f"op{number}_")]
    assert "pipeline" in names and set(entry_module.oracle_sql()) <= set(names)
