"""Every registered query against its oracle SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from rawstar import catalog

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LIBRARY = catalog.all_queries()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in LIBRARY}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in LIBRARY}
# At this scale these reports are rightly empty.
MAY_BE_EMPTY = {"bad_row_ranges", "select_row_ranges", "unique_violations", "missing_scope"}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    difference = oracle.compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR)
    if name in MAY_BE_EMPTY and difference == "both sides are empty":
        difference = None
    assert difference is None, difference


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
