"""Every registered query gives the rows of its SQL."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry_module
from tidemark.checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def database():
    return compare.database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SMALL)
    assert compare.difference(frame, database, ORACLES[name]) is None


def test_entry_has_rows_and_names(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == [
        "sport", "medal", "sex", "country_noc", "avg_height", "avg_weight",
    ]
    assert frame.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
