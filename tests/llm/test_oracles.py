"""The registered SQL of each operator that has one."""

import pytest
from conftest_path import SF_SMALL

from permscope.llm.queries import ORACLES, QUERIES
from permscope.plans.verify import duck_connect


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    con = duck_connect(SF_SMALL)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key)
