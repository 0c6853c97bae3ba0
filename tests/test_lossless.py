"""Ingest, stores and rules lose nothing: depth, trailing text, odd ACEs, mixed types, several runs."""

import json

import pytest
from pyspark.sql import functions as F

from permscope.functions.masks import is_full_control
from permscope.functions.patterns import wildcard_like
from permscope.operators import identity as ID
from permscope.operators.finders import everyone_full_control, folders_missing_admin_full, missing_admins
from permscope.operators.rules import apply_rules
from permscope.session import checkpoint_dir
from permscope.sources import acl_json as AJ
from permscope.sources.parquet import read_aces, read_shares_csv, write_aces
from permscope.streaming.ingest import incremental_ingest, read_ingested


def files(spark, **texts):
    return spark.createDataFrame([("r", k, v) for k, v in texts.items()], "run_id string, source_file string, text string")


ACE = {"Identity": "Bob", "Rights": "Modify"}


@pytest.mark.parametrize("depth", [1, 19, 20, 21, 45])
def test_nodes_at_any_depth(spark, depth):
    doc = {"Access": [ACE]}
    for k in range(depth):
        doc = {"child": doc} if k % 2 else [doc]
    assert AJ.acl_nodes(files(spark, f=json.dumps(doc))).count() == 1


def test_text_after_the_value_is_quarantined(spark):
    one = json.dumps({"Access": [ACE]})
    bad = {"two": one + one, "words": one + " xyz", "bracket": one + "]", "brace": one + "}", "comma": one + "," + one,
           "pair": one + ',"y":{}', "bare": "3", "text": '"x"', "empty": "", "open": one[:-1], "close": "[" + one + "]]"}
    good = {"ok": one, "spaces": f" \n{one}\n ", "bom": "﻿" + one, "array": f"[{one}]", "none": "{}", "nothing": "[]"}
    df = files(spark, **bad, **good)
    assert {r.source_file for r in AJ.malformed_files(df).collect()} == set(bad)
    assert {r.source_file for r in AJ.acl_nodes(df).collect()} == {"ok", "spaces", "bom", "array"}


def test_typed_path_reads_every_ace_form(spark):
    rec = {"UncPath": "\\\\f\\s\\a", "Access": [ACE, "DOM\\x Read", {"Name": "Old", "Mask": "0x1F01FF", "SID": "S-1"}, 7]}
    other = {"UncPath": "\\\\f\\s\\b", "Access": [ACE], "Extra": {"Acl": [ACE]}}
    df = files(spark, known=json.dumps([rec]), one=json.dumps(rec), hidden=json.dumps(other), odd=json.dumps({"x": {"Aces": [ACE]}}))
    cols = ["source_file", "ace_sid", "ace_name", "ace_type", "ace_mask", "ace_inherited", "ace_raw", "unc_path"]
    key = lambda d: sorted(map(str, d.select(cols).collect()))
    generic = AJ.nodes_to_aces(AJ.acl_nodes(df))
    assert key(AJ.all_aces(df)) == key(generic)
    assert {r.source_file for r in AJ.untyped_files(df).collect()} == {"hidden", "odd"}
    assert AJ.typed_aces(df).where("source_file = 'known'").count() == 4


def test_stream_equals_batch(spark, tmp_path):
    one = json.dumps({"UncPath": "\\\\f\\s\\a", "Access": [ACE]})
    for name, text in {"run-1/folderacls/a.json": one, "run-1/folderacls/x.schema.json": one, "nest/run-2/folderacls/b.json": one,
                       "run-1/folderacls/bad.json": one + " tail", "run-1/other/c.json": one}.items():
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    root, out, bad = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad")
    incremental_ingest(spark, root, out, str(tmp_path / "progress"), quarantine_dir=bad)
    cols = ["run_id", "source_file", "folder_path", "ace_name"]
    want = sorted(map(tuple, AJ.ingest_acl_json(spark, root).select(cols).collect()))
    assert sorted(map(tuple, read_ingested(spark, out).select(cols).collect())) == want
    assert [r[0] for r in want] == ["run-1", "run-2"]
    assert [r.source_file.rsplit("/", 1)[1] for r in spark.read.parquet(bad).collect()] == ["bad.json"]


def test_mixed_mask_types_and_corrupt_files(spark, tmp_path):
    p = tmp_path / "aces"
    for run, typ, mask in (("a", "string", "FullControl"), ("b", "long", 2032127), ("c", "string", "0x1F01FF")):
        spark.createDataFrame([("f", "Everyone", mask)], f"folder_path string, ace_name string, ace_mask {typ}").coalesce(1) \
            .write.parquet(str(p / f"run_id={run}"))
    (p / "run_id=a" / "junk.parquet").write_bytes(b"not parquet")
    before = spark.conf.get("spark.sql.files.ignoreCorruptFiles")
    got = read_aces(spark, str(p))
    assert sorted((r.run_id, r.ace_mask) for r in got.collect()) == [("a", "FullControl"), ("b", "2032127"), ("c", "0x1F01FF")]
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == before
    assert everyone_full_control(got).count() == 3


def test_full_control_by_bits(spark):
    masks = ["FullControl", "fullControl, Read", "2032127", "0x1F01FF", "0x1f01ff", "268435456", "0x10000000", "2032126", "1",
             "0", "", None, "Modify", "0xzz"]
    got = [r[0] for r in spark.createDataFrame([(m,) for m in masks], "m string").select(is_full_control("m")).collect()]
    assert got == [True] * 7 + [False] * 7
    aces = spark.createDataFrame([("r", "\\\\f\\a", "DOM\\Domain Admins", "2032127")],
                                 "run_id string, folder_path string, ace_name string, ace_mask string")
    assert folders_missing_admin_full(aces).count() == 0


def test_runs_are_counted_apart(spark):
    one = [(r, "s.json", "\\\\f\\a", "bob", "Read") for r in ("r1", "r2")]
    cols = "run_id string, source_file string, folder_path string, ace_name string, ace_mask string"
    assert apply_rules(spark.createDataFrame(one, cols)).where("rule_id = 'DuplicateAceEntries'").count() == 0
    twice = spark.createDataFrame(one + one[:1], cols)
    got = apply_rules(twice, keep=("run_id",)).where("rule_id = 'DuplicateAceEntries'").collect()
    assert [r.run_id for r in got] == ["r1", "r1"]
    admins = one + [("r1", "s.json", "\\\\f\\a", "DOM\\Domain Admins", "FullControl")]
    assert missing_admins(spark.createDataFrame(admins, cols)).count() == 1


@pytest.mark.parametrize("pattern,hits", [("svc[0-9]", ["svc1", "a SVC9 b"]), ("[ab]x", ["bx"]), ("svc[", ["svc["]),
                                          ("v[^1]", ["v^"]), ("s?c*[9]", ["a SVC9 b"])])
def test_wildcard_classes(spark, pattern, hits):
    words = ["svc1", "a SVC9 b", "svcx", "bx", "cx", "svc[", "v^"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").where(wildcard_like("w", pattern)).collect()]
    assert got == hits


def test_effective_access_evidence_survives_its_deny(spark):
    users = spark.createDataFrame([("s", "U")], "snapshot_id string, sid string")
    closure = spark.createDataFrame([], "snapshot_id string, member_sid string, group_sid string")
    rows = [(None, "U", "Read", "allow", False), (None, "U", "FullControl", "allow", True), (None, "U", "Read", "deny", True)]
    aces = spark.createDataFrame(rows, "folder_path string, ace_sid string, ace_mask string, ace_type string, ace_inherited boolean")
    got = ID.effective_access(aces, users, closure)
    assert [(r.rights_bucket, r.matched_mask) for r in got.collect()] == [("read", "Read")]
    assert ID.effective_access_diff(got, got).count() == 0


def test_long_membership_chains(spark):
    edges = spark.createDataFrame([("s", f"n{k:03d}", f"n{k + 1:03d}") for k in range(12)],
                                  "snapshot_id string, member_sid string, group_sid string")
    assert ID.membership_closure(edges).count() == 12 * 13 // 2


def test_only_a_missing_inventory_is_empty(spark, tmp_path):
    assert read_shares_csv(spark, str(tmp_path / "no.csv")).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        read_shares_csv(spark, "nosuchfs://x/shares.csv").count()


def test_a_cluster_must_name_its_checkpoint_folder():
    class Conf:
        def get(self, k, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_a_hot_folder_is_written_to_several_files(spark, tmp_path):
    n = 200_000
    aces = spark.range(n).select(F.lit("r").alias("run_id"), F.lit("\\\\f\\hot").alias("folder_path"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("ace_name"), F.lit("Read").alias("ace_mask"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        write_aces(aces.repartition(8), str(tmp_path / "aces"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = read_aces(spark, str(tmp_path / "aces"))
    assert got.count() == n and got.select(F.input_file_name()).distinct().count() > 1
