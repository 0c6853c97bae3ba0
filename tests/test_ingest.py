"""Folder-ACL JSON ingest on hand-written exporter files."""

import json
import os

import pytest

from permscope.sources.acl_json import ingest_acl_json, malformed_files, read_folderacl_files, run_text_summary
from permscope.sources.parquet import read_aces, read_shares_csv, write_aces


def _write(root, name, obj, raw=False):
    d = os.path.join(root, "run-20260101-000000", "folderacls")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(obj if raw else json.dumps(obj))


@pytest.fixture(scope="module")
def run_root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("acls"))
    _write(root, "share101.json", [{
        "UncPath": "\\\\filer01.corp\\sharea\\Finance", "CollectedUtc": "2026-01-01T00:00:00Z",
        "CollectionHost": "collector1", "Collector": "x", "Owner": "BUILTIN\\Administrators", "Sddl": "O:BA",
        "ApplianceHostname": "app01", "ShareName": "sharea",
        "Access": [{"Identity": "EXAMPLE\\Domain Users", "Rights": "FullControl", "Type": "Allow",
                    "IsInherited": False},
                   {"Identity": "Everyone", "Rights": "ReadAndExecute", "Type": "Allow", "IsInherited": True}],
        "FingerprintSha256": "abc", "CollectionSha256": "def"}])
    _write(root, "legacy.json", {"path": "\\\\f\\s\\legacy", "acl": [
        {"sid": "S-1-1-0", "name": "Everyone", "type": "allow", "mask": 2032127, "inherited": "false"},
        {"SID": "S-1-5-21-1", "Name": "Dup", "name": "dup-last", "mask": "0x2"}]})
    _write(root, "nested.json", {"export": {"items": [{"folder": {"UncPath": "\\\\f\\s\\deep",
                                                                   "Rights": [{"name": "Deep User", "mask": "Modify"}]}}]}})
    _write(root, "both.json", {"UncPath": "\\\\f\\s\\both", "Access": [{"name": "A"}], "Rights": [{"name": "B"}]})
    _write(root, "empty.json", {"UncPath": "\\\\f\\s\\empty", "Attributes": ["Directory"], "Access": []})
    _write(root, "bare.json", {"UncPath": "\\\\f\\s\\bare", "Access": ["Everyone:F", {"name": "obj"}]})
    _write(root, "broken.json", "{ not json", raw=True)
    _write(root, "com.example.acl-export-1.0.1.schema.json", {"$schema": "x", "properties": {"Access": []}})
    _write(root, "bom.json", "\ufeff" + json.dumps({"UncPath": "\\\\f\\s\\bom", "Access": [{"name": "Bommy"}]}), raw=True)
    return root


@pytest.fixture(scope="module")
def aces(spark, run_root):
    return ingest_acl_json(spark, run_root).cache()


def test_schema_101_file(aces):
    rows = aces.filter(aces.unc_path.endswith("Finance")).collect()
    assert len(rows) == 2
    du = [r for r in rows if "Domain Users" in r.ace_name][0]
    assert du.ace_mask == "FullControl" and du.ace_inherited is False and du.ace_type == "Allow"
    assert du.folder_path == "\\\\app01\\sharea\\Finance"          # canonical host\share\leaf
    assert du.run_id == "run-20260101-000000" and du.owner == "BUILTIN\\Administrators"


def test_legacy_lowercase_and_case_duplicates(aces):
    rows = {r.ace_sid: r for r in aces.filter(aces.unc_path.endswith("legacy")).collect()}
    assert rows["S-1-1-0"].ace_mask == "2032127" and rows["S-1-1-0"].ace_inherited is False
    assert rows["S-1-5-21-1"].ace_name == "dup-last" and rows["S-1-5-21-1"].ace_mask == "0x2"


def test_nested_node_found(aces):
    rows = aces.filter(aces.unc_path.endswith("deep")).collect()
    assert [r.ace_name for r in rows] == ["Deep User"]


def test_node_with_two_acl_keys_emitted_once(aces):
    rows = aces.filter(aces.unc_path.endswith("both")).collect()
    assert [r.ace_name for r in rows] == ["A"]


def test_empty_acl_dropped_and_attributes_not_aces(aces):
    assert aces.filter(aces.unc_path.endswith("empty")).count() == 0


def test_non_object_ace_keeps_raw(aces):
    rows = aces.filter(aces.unc_path.endswith("bare")).orderBy("ace_raw").collect()
    assert rows[0].ace_raw == "Everyone:F" and rows[0].ace_name is None


def test_bom_and_schema_and_malformed(spark, run_root, aces):
    assert aces.filter(aces.unc_path.endswith("bom")).count() == 1
    files = read_folderacl_files(spark, run_root)
    names = {r.file_name for r in files.collect()}
    assert not any("schema" in n for n in names)
    bad = [r.source_file for r in malformed_files(files).collect()]
    assert len(bad) == 1 and bad[0].endswith("broken.json")


def test_text_summary(spark, run_root):
    s = run_text_summary(read_folderacl_files(spark, run_root)).collect()[0]
    assert s.files == 8 and s.aces_approx == 2 and s.distinct_sids == 2


def test_parquet_round_trip_and_shares(spark, aces, tmp_path):
    out = str(tmp_path / "aces")
    write_aces(aces, out)
    back = read_aces(spark, out)
    assert back.count() == aces.count()
    assert set(back.columns) >= {"run_id", "folder_path", "ace_mask", "attributes"}
    missing = read_shares_csv(spark, str(tmp_path / "nope.csv"))
    assert missing.count() == 0
    p = tmp_path / "shares.csv"
    p.write_text("filer_name,share_name,volume_name,volume_guid\nfiler,sharea,volA,guid-volA\n")
    sh = read_shares_csv(spark, str(p)).collect()
    assert sh[0].volume_name == "volA" and sh[0].row_no == 0


def test_json_lines_mode(spark, tmp_path):
    d = tmp_path / "run-x" / "folderacls"
    d.mkdir(parents=True)
    lines = [json.dumps({"UncPath": f"\\\\f\\s\\p{i}", "Access": [{"name": f"N{i}"}, {"name": "E"}]}) for i in range(5)]
    (d / "big.json").write_text("\n".join(lines) + "\n")
    aces = ingest_acl_json(spark, str(tmp_path), json_lines=True)
    assert aces.count() == 10 and aces.select("unc_path").distinct().count() == 5


def test_sinks(spark, tmp_path):
    from helpers import ace_df
    from permscope.operators.rules import apply_rules, split_by_severity
    from permscope.sources.parquet import write_findings_csv

    m = apply_rules(ace_df(spark, [("\\\\f\\s\\x", "RegularUser", "S-1-5-21-1", "FullControl"),
                                   ("\\\\f\\s\\y", "Bob", "S-1-5-21-2", "Read"),
                                   ("\\\\f\\s\\y", "Bob", "S-1-5-21-2", "Read")]))
    split_by_severity(m, str(tmp_path / "split"))
    parts = sorted(p.name for p in (tmp_path / "split").iterdir() if p.name.startswith("severity="))
    assert parts == ["severity=high", "severity=low", "severity=medium"]
    write_findings_csv(m.limit(0), str(tmp_path / "empty"))
    csvs = [p for p in (tmp_path / "empty").iterdir() if p.suffix == ".csv"]
    assert csvs and csvs[0].read_text().startswith("rule_id,severity,folder_path")


def test_analyze_run(spark, run_root, tmp_path):
    from permscope.plans.analyze import analyze_run

    res = analyze_run(spark, run_root, str(tmp_path / "out"))
    assert res["aces"].count() > 0
    ids = {r.rule_id for r in res["findings"].collect()}
    assert "DomainUsersFullControl" in ids          # Domain Users FullControl in the 1.0.1 file
    assert res["quarantine"].count() == 1
    assert res["top_identities_high_perms"].count() > 0


def test_compat_any_list_mode(spark, run_root):
    strict = ingest_acl_json(spark, run_root)
    compat = ingest_acl_json(spark, run_root, compat_any_list=True)
    assert strict.filter(strict.unc_path.endswith("empty")).count() == 0
    rows = compat.filter(compat.unc_path.endswith("empty")).collect()
    assert [(r.ace_raw, r.ace_name) for r in rows] == [("Directory", None)]   # Attributes became "ACEs"


def test_typed_fast_path_equals_generic(spark, tmp_path):
    from pyspark.sql import functions as F
    from permscope.sources.acl_json import acl_nodes, nodes_to_aces, typed_aces

    d = tmp_path / "run-t" / "folderacls"
    d.mkdir(parents=True)
    (d / "v101.json").write_text(json.dumps([{
        "UncPath": "\\\\filer01.corp\\sharea\\Finance", "ApplianceHostname": "app01", "ShareName": "sharea",
        "CollectedUtc": "2026-01-01T00:00:00Z", "Owner": "o", "Attributes": ["Directory"],
        "Access": [{"Identity": "Everyone", "Rights": "Modify", "Type": "Allow", "IsInherited": True},
                   {"Identity": "Bob", "Rights": 2032127, "Type": "Allow", "IsInherited": False}]}]))
    (d / "v100.json").write_text(json.dumps({
        "Path": "\\\\h\\s\\legacy", "Host": "collector9", "CollectedUtc": "2026-01-02T00:00:00Z",
        "Access": [{"Identity": "Domain Users", "Rights": "Read", "Type": "Allow", "IsInherited": False}]}))
    files = read_folderacl_files(spark, str(tmp_path))
    cols = ["run_id", "folder_path", "unc_path", "ace_name", "ace_mask", "ace_type", "ace_inherited",
            "collection_host", "collected_utc", "owner", "attributes"]
    typed = typed_aces(files).select(cols)
    generic = nodes_to_aces(acl_nodes(files)).select(cols)
    assert typed.count() == 3
    assert typed.exceptAll(generic).count() == 0 and generic.exceptAll(typed).count() == 0
    assert typed.filter(F.col("ace_mask") == "2032127").count() == 1


def test_file_audit_reports_apart(spark, run_root):
    from permscope.sources.acl_json import folderacl_file_audit

    a = folderacl_file_audit(spark, run_root).collect()[0]
    # 9 files: 1 schema artifact, 1 malformed, 7 parsed ('empty.json' holds an
    # ACL key with an empty list, which is still a node)
    assert (a.files_found, a.files_skipped, a.files_malformed) == (9, 1, 1)
    assert (a.files_with_acl, a.files_without_acl) == (7, 0)


def test_documents_are_parsed_once_per_use(spark):
    # a filter inferred from an explode, or a lambda's value used twice, parses every document again
    from permscope.sources import acl_json as AJ

    files = spark.createDataFrame([("r", "f", '[{"UncPath":"x","Access":[{"Sid":"S-1-1-0"}]}]'), ("r", "g", "[1] 2"), ("r", "h", "7")],
                                  "run_id string, source_file string, text string").repartition(2)
    aces = AJ.typed_aces(files)
    assert aces._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= 8
    assert [(a.source_file, a.ace_sid, a.ace_pos) for a in aces.collect()] == [("f", "S-1-1-0", 0)]
    assert {r.source_file for r in AJ.malformed_files(files).collect()} == {"g", "h"}
