"""Library entry points: check dispatch, dry run, SQL view, broad CSV twin."""

import json
import os

import pytest

from helpers import ace_df

from permscope.operators import finders as FD
from permscope.operators.rules import run_checks
from permscope.sources.acl_json import ingest_acl_json, ingest_candidates
from permscope.sources.parquet import read_broad_csv, register_ace_view, write_aces


def test_run_checks_dispatch(spark):
    aces = ace_df(spark, [("\\\\f\\s\\hr1", "Everyone", "S-1-1-0", "Modify"),
                          ("\\\\f\\s\\hr1", "Administrators", "S-1-5-32-544", "FullControl"),
                          ("\\\\f\\s\\x", "Bob", "S-1-5-21-9", "Read")])
    from pyspark.sql import functions as F
    aces = aces.withColumn("source_file", F.lit("f.json"))
    out = run_checks(aces, ["EveryoneModify", "AdminsMissing", "AclTooManyAces", "everyone_full_control"])
    assert {r.ace_name for r in out["EveryoneModify"].collect()} == {"Everyone"}      # perm rule -> broad perms
    assert {r.folder_path for r in out["AdminsMissing"].collect()} == {"\\\\f\\s\\x"}  # presence rule
    assert out["AclTooManyAces"].count() == 0                                       # other rule -> rule engine
    assert out["everyone_full_control"].count() == 0
    with pytest.raises(KeyError):
        run_checks(aces, ["NoSuchCheck"])


def test_dry_run_view_and_broad_csv(spark, tmp_path):
    d = tmp_path / "runs" / "run-7" / "folderacls"
    os.makedirs(d)
    (d / "one.json").write_text(json.dumps({"UncPath": "\\\\f\\s\\a", "Access": [{"name": "Everyone", "mask": "Modify"}]}))
    (d / "none.json").write_text(json.dumps({"UncPath": "\\\\f\\s\\b", "Note": "no acl here"}))
    cand = ingest_candidates(spark, str(tmp_path / "runs"), "/out", n=20).collect()
    assert [r.target for r in cand] == ["/out/run-7/one.parquet"]

    write_aces(ingest_acl_json(spark, str(tmp_path / "runs")), str(tmp_path / "store"))
    register_ace_view(spark, str(tmp_path / "store"), "aces_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM aces_view WHERE run_id = 'run-7'").first().n == 1

    bp = FD.broad_perms(spark.table("aces_view"))
    bp.write.option("header", True).csv(str(tmp_path / "broad"))
    ranked = FD.identity_ranking(read_broad_csv(spark, str(tmp_path / "broad"))).collect()
    assert [(r.identity, r.folder_count, r.matched_rules) for r in ranked] == [
        ("Everyone", 1, "DomainUsersFullControl,EveryoneModify")]
