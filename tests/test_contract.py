"""Contract violations by file, record, field and rule; footers read in tasks."""

import json
from collections import Counter

from pyspark.sql import functions as F

from permscope.operators import contract as CT
from permscope.sources.parquet import file_schemas, read_aces, unreadable_files


def record(**change):
    r = {"UncPath": "\\\\h\\s\\a", "CollectedUtc": "2026-02-09T10:11:12Z", "CollectionHost": "c", "Collector": "x", "Owner": "o", "Sddl": "O:BA",
         "Access": [{"Identity": "i", "Rights": "Read", "IsInherited": True}], "FingerprintSha256": "f", "CollectionSha256": "g", "Other": [1]}
    r.update(change)
    return {k: v for k, v in r.items() if v != "gone"}


CASES = [
    (record(), []),
    (record(Owner="gone", Access="gone"), [("Owner", "required"), ("Access", "required")]),
    (record(Owner=None), [("Owner", "type")]),
    (record(Owner=5, Attributes="x"), [("Owner", "type"), ("Attributes", "type")]),
    (record(CollectedUtc="2026-02-09"), [("CollectedUtc", "format")]),
    (record(CollectedUtc="2026-02-31T10:00:00+01:00"), [("CollectedUtc", "format")]),
    (record(CollectedUtc="2026-02-09t10:11:12.5-03:00"), []),
    (record(CollectedUtc=1), [("CollectedUtc", "type")]),
    (record(Access=[{"IsInherited": "yes"}, {"IsInherited": "no", "Rights": 3}, {"Rights": "x"}]),
     [("Access[].IsInherited", "type"), ("Access[].Rights", "type")]),
    (record(Access=["bare", {}]), [("Access[]", "type")]),
    (record(Access={}, Attributes=["a", 1]), [("Access", "type"), ("Attributes[]", "type")]),
]


def test_violations(spark):
    rows = [("r", f"f{k}", json.dumps(r)) for k, (r, _) in enumerate(CASES)] + [("r", "bad", "{nope"), ("r", "list", "[1]"), ("r", "none", None)]
    found = CT.violations(spark.createDataFrame(rows, "run_id string, source_file string, text string"), CT.exporter_contract())
    got = Counter((r.source_file, r.field, r.rule) for r in found.collect())
    want = Counter((f"f{k}", f, rule) for k, (_, broken) in enumerate(CASES) for f, rule in broken)
    want.update([("bad", "", "json"), ("list", "", "type"), ("none", "", "json")])
    assert got == want
    per_file = {(r.source_file, r.field, r.rule): r.records for r in CT.violations_per_file(found).collect()}
    assert per_file == dict(want)


def test_older_version_and_own_schema(spark):
    old = {"Path": "p", "Host": "h", **{k: v for k, v in record().items() if k not in ("UncPath", "CollectionHost")}}
    df = spark.createDataFrame([("r", "f", json.dumps(old))], "run_id string, source_file string, text string")
    assert CT.violations(df, CT.exporter_contract("1.0.0")).count() == 0
    assert {r.field for r in CT.violations(df, CT.exporter_contract()).collect()} == {"UncPath", "CollectionHost"}
    own = {"type": "object", "properties": {"Owner": {"enum": ["a", "b"]}, "n": {"type": ["integer", "null"]}, "x": {"type": "number"}}, "required": ["n"]}
    assert {(r.field, r.rule) for r in CT.violations(df, own).collect()} == {("Owner", "enum"), ("n", "required")}


def test_footers(spark, tmp_path):
    base = spark.createDataFrame([("f", "s", "1")], "folder_path string, ace_sid string, ace_mask string")
    for k, df in enumerate([base, base, base.withColumn("ace_mask", F.lit(7)), base.toDF("Folder_Path", "ACE_SID", "ACE_MASK")]):
        df.coalesce(1).write.parquet(str(tmp_path / "store" / f"run_id=r {k}"))
    (tmp_path / "store" / "run_id=r 0" / "broken.parquet").write_bytes(b"PAR1 nothing")
    schemas = file_schemas(spark, str(tmp_path / "store"))
    assert sorted(Counter(r.schema for r in schemas.collect()).values()) == [1, 1, 3]
    bad = unreadable_files(spark, str(tmp_path / "store")).collect()
    assert [r.file.rsplit("/", 1)[1] for r in bad] == ["broken.parquet"] and bad[0].error
    aces = read_aces(spark, str(tmp_path / "store"))
    assert sorted((r.run_id, r.ace_mask) for r in aces.collect()) == [("r 0", "1"), ("r 1", "1"), ("r 2", "7"), ("r 3", "1")]


def test_values_are_read_once(spark):
    # every rule used to read the record again, and name the schema of all of it
    df = spark.createDataFrame([("r", "f", json.dumps(record()))], "run_id string, source_file string, text string")
    plan = CT.violations(df, CT.exporter_contract())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_variant_get(_v#") <= 3
    assert not plan.count("schemaOfVariant(_v#") and not plan.count("schema_of_variant(_v#")


def test_nested_and_odd_names(spark):
    own = {"type": "object", "required": ["a", "A"], "properties": {
        "a": {"type": "object", "required": ["b.c"], "properties": {"b.c": {"type": "array", "items": {"type": ["string", "null"]}}, "t`": {"type": "string"}}},
        "A": {"type": "array", "items": {"type": "object", "required": ["x"], "properties": {"x": {"type": "array", "items": {"type": "integer"}}}}}}}
    rows = [{"a": {"b.c": ["s", None]}, "A": [{"x": [1]}]}, {"a": {"b.c": [1], "t`": 2}, "A": [{}, None, {"x": ["s"]}]}, {"a": {}, "A": None}, {}]
    df = spark.createDataFrame([("r", str(k), json.dumps(r)) for k, r in enumerate(rows)], "run_id string, source_file string, text string")
    assert {(r.source_file, r.field, r.rule) for r in CT.violations(df, own).collect()} == {
        ("1", "a.b.c[]", "type"), ("1", "a.t`", "type"), ("1", "A[].x", "required"), ("1", "A[]", "type"), ("1", "A[].x[]", "type"),
        ("2", "a.b.c", "required"), ("2", "A", "type"), ("3", "a", "required"), ("3", "A", "required")}
