"""Every catalogued query against its DuckDB oracle at sf0.001, plus the
driver contract of ``__spark_entry__``."""

import pytest

from helpers import SF_SMALL

import __spark_entry__ as entry_mod
from permscope.plans.verify import compare, duck_connect

from permscope.plans import catalog

QUERIES = sorted(catalog.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["rule_id", "severity", "folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, [name], con=con, verbose=False)[name]
    assert res["ok"], res
