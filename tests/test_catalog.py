"""Every registered query against its SQL on DuckDB."""

import importlib.util
import os

import pytest

from larkspur.plans import catalog

_spec = importlib.util.spec_from_file_location(
    "check", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "check.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, folder, name):
    rows, same, detail = check.compare(spark, con, folder, name)
    assert same, detail


def test_entry_matches_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).dtypes == [("id", "bigint"), ("prediction", "int")]
