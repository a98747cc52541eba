"""Every registered query against its SQL oracle, on the smallest test tables."""

import os
from pathlib import Path

import pytest
from check_oracles import difference, duck, duck_result, spark_result, type_differences

import __spark_entry__ as entry
from tidemark import jobs

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(jobs.oracles()) == set(jobs.queries())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert type_differences(df, con, ORACLES[name]) == {}
    assert difference(spark_result(df), duck_result(con, ORACLES[name])) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
