"""A third of all ACEs in one folder and under one identity: results stay
exact and no plan holds a window over raw rows or a per-group collection."""

import duckdb
import pandas as pd
import pytest

from permscope.operators import fingerprint as FP
from permscope.operators import reports as R
from permscope.operators.rules import apply_rules
from permscope.plans.q_rules import rules_oracle
from permscope.sources.ruleset import load_ruleset

N = 9000


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(N):
        if i % 3 == 0:   # the hot folder, all Everyone
            rows.append(("\\\\f\\s\\hot", "Everyone", "S-1-1-0", "Modify" if i % 2 else "Read", False, None))
        else:
            rows.append((f"\\\\f\\s\\d{i % 500}", f"User{i % 37}", f"S-1-5-21-{i % 37}",
                         ["FullControl", "Read", "Write"][i % 3], i % 5 == 0, None))
    cols = ["folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited", "ace_raw"]
    pdf = pd.DataFrame(rows, columns=cols)
    df = spark.createDataFrame(rows, "folder_path string, ace_name string, ace_sid string, ace_mask string, "
                                     "ace_inherited boolean, ace_raw string")
    return df, pdf


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_exact_under_skew(spark, skewed):
    df, pdf = skewed
    rs = load_ruleset()
    got = apply_rules(df, rs).groupBy("rule_id").count().collect()
    con = duckdb.connect()
    con.register("aces_df", pdf)
    con.execute("CREATE TABLE aces AS SELECT * FROM aces_df")
    want = con.execute(f"SELECT rule_id, COUNT(*) FROM ({rules_oracle(rs, fixtures=())}) GROUP BY 1").fetchall()
    assert sorted((r.rule_id, r["count"]) for r in got) == sorted(want)
    assert dict(want)["AclTooManyAces"] == N // 3       # the hot folder's ACEs


def test_no_window_or_collect_on_hot_keys(spark, skewed):
    df, _ = skewed
    for plan in (_plan(apply_rules(df)), _plan(FP.object_acl(df.selectExpr("'r' AS run_id", "*"))),
                 _plan(R.top_identities_high_perms(df))):
        assert "Window" not in plan and "collect_list" not in plan
    hot = FP.object_acl(df.selectExpr("'r' AS run_id", "*")).filter("folder_path LIKE '%hot'").first()
    assert hot.acl_ace_count == N // 3


def test_engine_settings_for_skew(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
