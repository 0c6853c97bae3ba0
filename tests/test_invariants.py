"""Invariants: fingerprints, closure, effective access, drift, streaming, metrics."""

import json
import os

from pyspark.sql import functions as F

from helpers import SF_SMALL, ace_df

from permscope.operators import drift as DR
from permscope.operators import identity as ID
from permscope.operators import metrics as MT
from permscope.operators.fingerprint import object_acl, rules_on_definitions
from permscope.operators.rules import apply_rules
from permscope.sources import fixtures as fx


def test_fingerprint_ignores_ace_order_and_partitioning(spark):
    rows = [("\\\\f\\s\\a", f"U{i}", f"S-1-5-21-{i}", "Read") for i in range(30)]
    a = ace_df(spark, rows)
    b = ace_df(spark, list(reversed(rows))).repartition(7)
    c = ace_df(spark, rows[:-1] + [("\\\\f\\s\\a", "U29", "S-1-5-21-29", "Modify")])
    fa, fb, fc = (object_acl(x.withColumn("run_id", F.lit("r"))).collect()[0].acl_fingerprint for x in (a, b, c))
    assert fa == fb and fa != fc


def test_fingerprint_is_path_independent(spark):
    rows = [("\\\\f\\s\\a", "U", "S-1", "Read"), ("\\\\f\\s\\b", "U", "S-1", "Read")]
    fps = {r.acl_fingerprint for r in object_acl(ace_df(spark, rows).withColumn("run_id", F.lit("r"))).collect()}
    assert len(fps) == 1


def test_closure_cycle(spark):
    edges = spark.createDataFrame([("s", "a", "b"), ("s", "b", "c"), ("s", "c", "a"), ("s", "u", "a")],
                                  "snapshot_id string, member_sid string, group_sid string")
    with_self = ID.membership_closure(edges, include_self=True)
    assert with_self.count() == 12
    closure = ID.membership_closure(edges)
    assert closure.count() == 9
    again = ID.membership_closure(closure)          # idempotent
    assert again.count() == 9


def test_effective_access_nested_group_and_deny(spark):
    edges = spark.createDataFrame([("s", "u1", "g1"), ("s", "g1", "g2")],
                                  "snapshot_id string, member_sid string, group_sid string")
    users = spark.createDataFrame([("s", "u1")], "snapshot_id string, sid string")
    aces = spark.createDataFrame([
        ("\\\\f\\s\\a", "g2", "Modify", "allow", False),          # via nested group: write
        ("\\\\f\\s\\b", "g2", "FullControl", "allow", False),
        ("\\\\f\\s\\b", "g1", "Write", "deny", False),            # explicit deny of write caps at read
        ("\\\\f\\s\\c", "g1", "FullControl", "allow", False),
        ("\\\\f\\s\\c", "u1", "Write", "deny", True),             # inherited deny loses to explicit allow
    ], "folder_path string, ace_sid string, ace_mask string, ace_type string, ace_inherited boolean")
    ea = {r.folder_path: r for r in ID.effective_access(aces, users, ID.membership_closure(edges)).collect()}
    assert ea["\\\\f\\s\\a"].rights_bucket == "write" and ea["\\\\f\\s\\a"].via == "group"
    assert ea["\\\\f\\s\\b"].rights_bucket == "read"
    assert ea["\\\\f\\s\\c"].rights_bucket == "fullcontrol"


def test_drift_partition(spark):
    a = apply_rules(fx.aces(spark, SF_SMALL, "a"))
    b = apply_rules(fx.aces(spark, SF_SMALL, "b"))
    added, persisting = DR.findings_added(a, b), DR.findings_persisting(a, b)
    assert added.unionByName(persisting).distinct().count() == DR._keys(b).count()
    assert added.join(persisting, DR.FINDING_KEY, "inner").count() == 0


def test_rules_on_definitions_equals_rules(spark):
    aces = fx.aces(spark, SF_SMALL)
    from permscope.operators.fingerprint import local_rules
    from permscope.sources.ruleset import Ruleset, load_ruleset
    rs = load_ruleset()
    local = Ruleset(tuple(local_rules(rs)), rs.admin_identities, rs.version, rs.raw)
    direct = apply_rules(aces, local).withColumn("run_id", F.lit("run-a"))
    via_defs = rules_on_definitions(aces, rs)
    assert direct.exceptAll(via_defs.select(direct.columns)).count() == 0
    assert via_defs.select(direct.columns).exceptAll(direct).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    from permscope.sources.acl_json import ingest_acl_json
    from permscope.streaming.ingest import incremental_ingest, read_ingested

    d = tmp_path / "landing" / "run-x" / "folderacls"
    os.makedirs(d)
    for i in range(3):
        (d / f"f{i}.json").write_text(json.dumps([{"UncPath": f"\\\\f\\s\\p{i}",
                                                   "Access": [{"name": f"N{i}", "mask": "Read"}]}]))
    q = incremental_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert q is not None
    cols = ["run_id", "folder_path", "ace_name", "ace_mask"]
    streamed = read_ingested(spark, str(tmp_path / "out")).select(cols)
    batch = ingest_acl_json(spark, str(tmp_path / "landing")).select(cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # a second availableNow run finds nothing new (progress is checkpointed)
    incremental_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert read_ingested(spark, str(tmp_path / "out")).count() == 3


def test_metrics_with_and_without_shares(spark):
    aces = spark.createDataFrame([
        ("r", "f.json", "\\\\filer.dom\\sharea\\x", "A"), ("r", "f.json", "\\\\filer.dom\\sharea\\x", "B"),
        ("r", "f.json", "", "C")], "run_id string, source_file string, folder_path string, ace_name string")
    t = MT.scalability_totals(aces).collect()[0]
    assert (t.folderacl_files, t.acl_entries, t.total_aces) == (1, 1, 2)
    shares = spark.createDataFrame([("filer", "sharea", "volA", "guid-volA", 0)],
                                   "filer_name string, share_name string, volume_name string, volume_guid string, "
                                   "row_no long")
    v = MT.scalability_per_volume(aces, shares).collect()
    assert [(r.volume_name, r.volume_guid) for r in v] == [("vola", "guid-volA")]
    none = MT.scalability_per_volume(aces, shares.limit(0)).collect()
    assert [r.volume_name for r in none] == ["unknown"]


def test_stream_rescoring_sees_whole_folders(spark, tmp_path):
    from permscope.operators.rules import apply_rules
    from permscope.sources.acl_json import ingest_acl_json
    from permscope.streaming.ingest import incremental_ingest, read_findings

    land = tmp_path / "landing" / "run-s" / "folderacls"
    os.makedirs(land)
    args = (spark, str(tmp_path / "landing"), str(tmp_path / "aces"), str(tmp_path / "ckpt"))
    kw = dict(findings_dir=str(tmp_path / "findings"))
    (land / "a.json").write_text(json.dumps({"UncPath": "\\\\f\\s\\d", "Access": [{"name": "Bob", "mask": "Read"}]}))
    incremental_ingest(*args, **kw)
    assert {r.rule_id for r in read_findings(spark, kw["findings_dir"]).collect()} == set()
    # a second export of the same folder arrives later: Bob is now duplicated
    (land / "b.json").write_text(json.dumps({"UncPath": "\\\\f\\s\\d", "Access": [{"name": "Bob", "mask": "Read"}]}))
    incremental_ingest(*args, **kw)
    cur = read_findings(spark, kw["findings_dir"])
    batch = apply_rules(ingest_acl_json(spark, str(tmp_path / "landing")), keep=("run_id",))
    cols = ["run_id", "rule_id", "folder_path", "ace_name"]
    assert cur.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(cur.select(cols)).count() == 0
    assert "DuplicateAceEntries" in {r.rule_id for r in cur.collect()}
