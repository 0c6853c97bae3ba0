"""SDDL, canonical ACLs and the score store."""

import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from permscope.functions import sddl as SD
from permscope.operators import canonical as CA
from permscope.operators.rules import MATCH_COLUMNS, apply_rules
from permscope.operators.score_store import ScoreStore, folder_acls
from permscope.sources.ruleset import compile_ruleset, load_ruleset

SCHEMA = ("run_id string, folder_path string, ace_sid string, ace_name string, ace_mask string, ace_type string, "
          "ace_inherited boolean, ace_raw string, owner string, sddl string, collected_utc string")


def rows_of(spark, rows):
    return spark.createDataFrame([tuple(list(r) + [None] * (11 - len(r))) for r in rows], SCHEMA)


@pytest.mark.parametrize("text,owner,protected,aces", [
    ("O:BAG:SYD:PAI(A;OICI;FA;;;SY)(D;;0x2;;;S-1-5-21-1-2-3)", "S-1-5-32-544", True,
     [("allow", "OICI", 0x1F01FF, "S-1-5-18", False), ("deny", "", 2, "S-1-5-21-1-2-3", False)]),
    ("o:s-1-5-21-9-8d:ai(a;ciid;grgx;;;wd)", "S-1-5-21-9-8", False, [("allow", "CIID", 0x80000000 | 0x20000000, "S-1-1-0", True)]),
    ("D:AR(A;NPIO;FAFR;;;XX)S:AI(AU;SAFA;FA;;;WD)", None, False, [("allow", "NPIO", 0x1F01FF, "XX", False)]),
    ("O:SYG:SY", "S-1-5-18", None, []),
    ("O:ZZD:P", None, True, []),
    ("D:(XA;;FX;;;BA;(Member_of {SID(BA)}))(A;;7;;;BU)", None, False,
     [("allow", "", 0x1200A0, "S-1-5-32-544", False), ("allow", "", 7, "S-1-5-32-545", False)]),
    ("D:(A;;junk;;;BA)(too;short)", None, False, [("allow", "", None, "S-1-5-32-544", False)]),
    ("", None, None, []), (None, None, None, None),
])
def test_sddl(spark, text, owner, protected, aces):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(SD.sddl_owner(F.col("t")).alias("o"), SD.sddl_protected(F.col("t")).alias("p"), SD.sddl_aces(F.col("t")).alias("a")).first()
    assert (r.o, r.p) == (owner, protected)
    assert (r.a if r.a is None else [tuple(x) for x in r.a]) == aces


@pytest.mark.parametrize("words,codes", [("ContainerInherit, ObjectInherit", "OICI"), ("InheritOnly", "IO"), ("None", ""), (None, ""),
                                         ("NoPropagateInherit,InheritOnly", "NPIO"), ("CIOI", "OICI"), ("id", "ID"), ("nonsense", "")])
def test_flag_codes(spark, words, codes):
    assert spark.createDataFrame([(words,)], "w string").select(SD.flag_codes(F.col("w"))).first()[0] == codes


def test_fingerprint_sees_flags_and_no_names(spark):
    raw = '{"inheritanceFLAGS": "ObjectInherit", "PropagationFlags": "InheritOnly"}'
    acl = CA.object_acl(rows_of(spark, [
        ("r", "a", "S-1-5-2", "Old Name", "Read", "Allow", False, raw), ("r", "b", "S-1-5-2", "New Name", "Read", "allow", False, raw),
        ("r", "c", "S-1-5-2", "New Name", "Read", "allow", False, None), ("r", "d", "", "Nobody", "Read", "allow", False, None),
        ("r", "e", None, "Someone", "Read", "allow", False, None), ("q", "a", "S-1-5-2", "x", "Read", "allow", False, raw)])).collect()
    fp = {(r.run_id, r.folder_path): r.acl_fingerprint for r in acl}
    assert fp["r", "a"] == fp["r", "b"] == fp["q", "a"] != fp["r", "c"]
    assert len({fp["r", k] for k in "acde"}) == 4


def test_object_columns(spark):
    acl = {r.folder_path: r for r in CA.object_acl(rows_of(spark, [
        ("r", "a", "s", "n", "Read", "allow", False, None, "Bob", "O:SYD:P(A;;FA;;;BA)", "2026-01-02"),
        ("r", "a", "s", "n", "Read", "allow", False, None, "Bob", "O:SYD:P(A;;FA;;;BA)", "2026-01-03"),
        ("r", "b", "s", "n", "Read", "allow", False, None, "s-1-5-21-7", None, None), ("r", None, "s", "n", "Read")])).collect()}
    assert (acl["a"].is_protected, acl["a"].owner_sid, acl["a"].collected_at, acl["a"].acl_ace_count) == (True, "S-1-5-18", "2026-01-03", 2)
    assert (acl["b"].is_protected, acl["b"].owner_sid, acl["b"].collected_at) == (None, "S-1-5-21-7", None)
    assert acl[None].acl_ace_count == 1


@pytest.mark.parametrize("block", [1000, 4])
def test_definitions_hold_every_line(spark, block):
    rng = random.Random(block)
    rows = [("r", f"f{rng.randint(0, 5)}", f"S-1-{rng.randint(0, 30)}", "n", rng.choice(["Read", "Write"]), "allow", rng.random() < 0.5)
            for _ in range(150)]
    rows += [("r2",) + r[1:] for r in rows] + [("r2", "copy") + r[2:] for r in rows if r[1] == "f1"]
    df = rows_of(spark, rows).repartition(3)
    acls = {(r.run_id, r.folder_path): r.acl_fingerprint for r in CA.object_acl(df).collect()}
    parts = {}
    for r in CA.acl_definitions(df, block).collect():
        assert r.object_count == sum(v == r.acl_fingerprint for v in acls.values())
        parts.setdefault(r.acl_fingerprint, {})[r.block] = json.loads(r.canonical_acl_json)
        assert 0 <= r.block < r.blocks
    for (run, folder), fp in acls.items():
        want = Counter((s, m, i) for q, f, s, _, m, _, i in rows if (q, f) == (run, folder))
        got = {(x["sid"], x["mask"], x["inherited"]): x["n"] for part in parts[fp].values() for x in part}
        assert got == want
        for part in parts[fp].values():
            assert part == sorted(part, key=lambda x: [x[c] for c in CA.LINE_FIELDS])


def estate(seed, run):
    rng = random.Random(seed)
    names = ["Everyone", "Domain Users", "Administrators", "svc_x", "EXAMPLE\\joe", "", None, "S-1-5-21-9-1"]
    return [(run, rng.choice(["\\\\h\\s\\hr1", "\\\\h\\s\\payroll", "\\\\h\\s\\x", "\\\\h\\s\\y", "", None]), rng.choice(["", "S-1-1-0", "S-1-5-21-9-1", None]),
             rng.choice(names), rng.choice(["FullControl", "Modify", "Write", "2", None]), "allow", rng.random() < 0.3) for _ in range(60)]


def findings(df):
    return sorted(tuple(r) for r in df.select(*MATCH_COLUMNS).collect())


def test_store_equals_full_scoring(spark, tmp_path):
    rs = load_ruleset().with_threshold(8)
    a, stays = estate(1, "a"), "\\\\h\\s\\x"
    b = [r for r in estate(2, "b") if r[1] != stays] + [("b",) + r[1:] for r in a if r[1] == stays]
    a, b = rows_of(spark, a), rows_of(spark, b)
    store = ScoreStore(spark, str(tmp_path / "s"), rs)
    before = store.update(a, batch="1")
    assert findings(store.findings(before)) == findings(apply_rules(a, rs))
    first = {r.acl_fingerprint for r in store.scored().collect()}
    after = store.update(b, batch="2")
    assert findings(store.findings(after)) == findings(apply_rules(b, rs))
    assert findings(store.findings(before)) == findings(apply_rules(a, rs))
    batches = {r.acl_fingerprint: r.batch for r in store.scored().collect()}
    assert {f for f, k in batches.items() if k == "1"} == first
    same = {r.acl_fingerprint for r in before.collect()} & {r.acl_fingerprint for r in after.collect()}
    assert same and all(batches[f] == "1" for f in same)  # the folder that stayed was not scored again
    drift = {(r.change, *[r[c] for c in MATCH_COLUMNS if c != "severity"]) for r in store.drift(before, after).collect()}
    fa, fb = ({tuple(x[k] for k, c in enumerate(MATCH_COLUMNS) if c != "severity") for x in findings(apply_rules(df, rs))} for df in (a, b))
    assert drift == {("added", *x) for x in fb - fa} | {("removed", *x) for x in fa - fb}


def test_a_new_ruleset_scores_again_and_a_dead_batch_does_not_count(spark, tmp_path):
    df = rows_of(spark, estate(3, "a"))
    one = compile_ruleset({"version": "1", "rules": [{"id": "W", "severity": "high", "perm_match": "Write"}]})
    two = compile_ruleset({"version": "2", "rules": [{"id": "W", "severity": "low", "perm_match": "Write|Modify"}]})
    path = str(tmp_path / "s")
    for rs in (one, two):
        store = ScoreStore(spark, path, rs)
        acls = store.update(df)
        assert findings(store.findings(acls)) == findings(apply_rules(df, rs))
        assert {r.ruleset_version for r in store.findings(acls).collect()} == {rs.version}
    # matches without their entry in "scored" are of a batch that died
    (store.matches().drop("batch").withColumn("batch", F.lit("dead")).write.mode("append")
     .partitionBy("ruleset_version", "batch").parquet(f"{path}/matches"))
    assert findings(store.findings(acls)) == findings(apply_rules(df, two))
    assert store.update(df.limit(0)).count() == 0


def test_folder_acls_join_missing_and_empty_paths(spark):
    df = rows_of(spark, [("r", None, "s", "n", "Read"), ("r", "", "s", "n", "Read")])
    assert [(r.folder_path) for r in folder_acls(df).collect()] == [""]


def test_flags_and_protection_are_cheap_and_exact(spark):
    words = {"O I,c-i": "OICI", "OIX": "", "xObjectInherit": "", "x ObjectInherit": "OI", "objectinheritance": "OI", " | ": "", "sa FA id": "IDSAFA"}
    df = spark.createDataFrame(list(words.items()), "w string, want string")
    assert df.where(SD.flag_codes(F.col("w")) != F.col("want")).collect() == []
    texts = {"D:PAIS:AI(AU;SAFA;FA;;;WD)": True, "D:S:P(A;;FA;;;BA)": False, "O:BAD:ARAI(A;;FA;;;BA)": False, "G:DUD:NO_ACCESS_CONTROL": False, "O:BA": None,
             "D:NO_ACCESS_CONTROLP": True, "D:aips:(A;;FA;;;BA)": True}
    df = spark.createDataFrame(list(texts.items()), "t string, want boolean")
    assert df.where(~SD.sddl_protected(F.col("t")).eqNullSafe(F.col("want"))).collect() == []
    raw = '{"inheritanceFLAGS": "ObjectInherit", "InheritanceFlags": "ContainerInherit", "x": "y"}'
    aces = rows_of(spark, [("r", "a", "s", "n", "Read", "allow", False, t) for t in (raw, "[1]", "{", None, "{}")])
    assert sorted(r.flags for r in CA.canonical_lines(aces).collect()) == ["", "", "", "", "CI"]
    # the flags are picked from a column, not from a lambda's variable
    plan = CA.canonical_lines(aces)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"_raw#\d+\[inheritanceflags\]", plan)
