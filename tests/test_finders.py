"""Finder cases modelled on the reference's script tests (legacy JSON shapes)."""

import json
import os

import pytest

from permscope.operators import finders as FD
from permscope.sources.acl_json import ingest_acl_json, read_folderacl_files, run_text_summary

RULES = {"admin_identities": ["Administrators"],
         "rules": [{"id": "AdminsMissing", "match_admin_identities": True, "expect_presence": True,
                    "severity": "medium"},
                   {"id": "EveryoneModify", "identity_patterns": ["Everyone"], "perm_match": "(?i)modify|write|full",
                    "severity": "high"}]}


def _run(tmp_path, files):
    d = tmp_path / "run-1" / "folderacls"
    os.makedirs(d)
    for name, obj in files.items():
        (d / name).write_text(json.dumps(obj))
    return str(tmp_path)


def test_missing_admins_admin_with_read_only_is_missing(spark, tmp_path):
    root = _run(tmp_path, {
        "a.json": {"path": "\\\\f\\s\\none", "acl": [{"name": "User1", "rights": "FullControl"}]},
        "b.json": {"path": "\\\\f\\s\\full", "acl": [{"name": "BUILTIN\\Administrators", "rights": "FullControl"}]},
        "c.json": {"path": "\\\\f\\s\\read", "acl": [{"name": "BUILTIN\\Administrators", "rights": "Read"}]},
    })
    aces = ingest_acl_json(spark, root)
    missing = {r.folder_path for r in FD.missing_admins(aces, RULES).collect()}
    assert missing == {"\\\\f\\s\\none", "\\\\f\\s\\read"}


def test_broad_perms_legacy_object(spark, tmp_path):
    root = _run(tmp_path, {"x.json": {"path": "\\\\f\\s\\p", "acl": [
        {"sid": "S-1-1-0", "name": "Everyone", "type": "allow", "mask": "Modify", "inherited": False},
        {"sid": "S-1-5-21-1", "name": "Alice", "type": "allow", "mask": "Modify", "inherited": False},
        {"sid": "S-1-1-0", "name": "Everyone", "type": "allow", "mask": "Modify", "inherited": True}]}})
    aces = ingest_acl_json(spark, root)
    rows = FD.broad_perms(aces, RULES).collect()
    assert [(r.ace_name, r.matched_rules) for r in rows] == [("Everyone", "EveryoneModify")]
    assert len(FD.broad_perms(aces, RULES, include_inherited=True).collect()) == 2
    fallback = FD.broad_perms_targets(aces).collect()
    assert {r.matched_rules for r in fallback} == {"fallback"}


def test_accessible_by_identity_and_rule_id(spark, tmp_path):
    root = _run(tmp_path, {"x.json": {"path": "\\\\f\\s\\p", "acl": [
        {"sid": "S-1-5-21-7", "name": "EXAMPLE\\Domain Users", "mask": "Read"},
        {"sid": "S-1-5-32-544", "name": "Administrators", "mask": "FullControl"}]}})
    aces = ingest_acl_json(spark, root)
    assert [r.ace_name for r in FD.accessible_by(aces, "domain users", RULES).collect()] == ["EXAMPLE\\Domain Users"]
    assert [r.ace_name for r in FD.accessible_by(aces, "adminsmissing", RULES).collect()] == ["Administrators"]
    assert [r.ace_sid for r in FD.accessible_by(aces, "S-1-5-21-*", RULES).collect()] == ["S-1-5-21-7"]


def test_summary(spark, tmp_path):
    root = _run(tmp_path, {"x.json": {"path": "\\\\f\\s\\p", "acl": [
        {"sid": "S-1-1-0", "name": "Everyone"}, {"sid": "S-1-1-0", "name": "Everyone"},
        {"Sid": "S-1-5-21-9", "name": "Bob"}]}})
    s = run_text_summary(read_folderacl_files(spark, root)).collect()[0]
    assert (s.run_id, s.files, s.aces_approx, s.distinct_sids) == ("run-1", 1, 3, 2)
    exact = FD.run_summary(ingest_acl_json(spark, root)).collect()[0]
    assert (exact.files, exact.ace_rows, exact.folders, exact.distinct_sids) == (1, 3, 1, 2)


@pytest.mark.parametrize("word,expect", [("root", 2)])
def test_root_names(spark, word, expect):
    df = spark.createDataFrame([("root-ops", None), ("x", '{"name": "ROOT admin"}'), ("y", None)],
                               "ace_name string, ace_raw string")
    got = {r.name: r.hits for r in FD.root_name_counts(df, word).collect()}
    assert sum(got.values()) == expect and got["ROOT admin"] == 1
