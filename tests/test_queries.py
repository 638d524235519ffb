"""Every registered query against its DuckDB oracle, plus the driver contract."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle import compare, duck

import __spark_entry__ as entry_module
from vigil.plans.oracle import oracle_sql
from vigil.plans.queries import QUERIES

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry_is_the_flagship_report(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["county", "disease", "visit_date", "cases_last_7_days"]
    assert df.count() == 38
