"""Rule engine cases (one per shipped rule) and severity filtering."""

from helpers import ace_df

from permscope.operators.rules import apply_rules
from permscope.sources.ruleset import compile_ruleset, load_ruleset

FOLDER = "\\\\filer\\share\\Finance\\reports"


def rule_ids(spark, rows, **kw):
    return {r.rule_id for r in apply_rules(ace_df(spark, rows), **kw).collect()}


def test_non_admin_full_control(spark):
    assert "NonAdminFullControl" in rule_ids(spark, [("\\\\f\\s\\x", "RegularUser", "S-1-5-21-100", "FullControl")])


def test_orphaned_sid(spark):
    assert "OrphanedSIDsFullControl" in rule_ids(spark, [("\\\\f\\s\\x", "", "S-1-5-9999", "FullControl")])


def test_sensitive_path(spark):
    assert "SensitiveFoldersWrite" in rule_ids(spark, [(FOLDER, "Someone", "S-1-5-21-1", "Modify")])


def test_too_many_aces(spark):
    rows = [("\\\\f\\s\\big", f"User{i}", f"S-1-5-21-{i}", "Read") for i in range(150)]
    assert "AclTooManyAces" in rule_ids(spark, rows)


def test_duplicates(spark):
    rows = [("\\\\f\\s\\d", "Bob", "S-1-5-21-7", "Read"), ("\\\\f\\s\\d", "Bob", "S-1-5-21-7", "Read")]
    assert "DuplicateAceEntries" in rule_ids(spark, rows)


def test_service_accounts(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "backup_svc", "S-1-5-21-8", "FullControl"),
                           ("\\\\f\\s\\y", "serviceAccount$", "S-1-5-21-9", "FullControl")])
    assert "ServiceAccountFullControl" in ids


def test_broad_system_groups(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "Authenticated Users", "S-1-5-11", "Modify"),
                           ("\\\\f\\s\\x", "ANONYMOUS LOGON", "S-1-5-7", "Write")])
    assert "AuthUsersBroadPerms" in ids


def test_ownership_rights(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "Carol", "S-1-5-21-3", "WRITE_OWNER"),
                           ("\\\\f\\s\\x", "Dave", "S-1-5-21-4", "Write_DAC")])
    assert "TakeOwnershipOrChangePerms" in ids


def test_external_principal(spark):
    assert "ExternalPrincipalAccess" in rule_ids(spark, [("\\\\f\\s\\x", "user@example.com", "S-1-5-21-5", "Read")])


def test_admin_not_non_admin_full(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "Administrators", "S-1-5-32-544", "FullControl")])
    assert "NonAdminFullControl" not in ids
    # admins are matched by the admin rule (decision D4), not excluded from it
    assert "AdminsPresent" in ids


def test_admins_present_compat_mode_never_fires(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "Administrators", "S-1-5-32-544", "FullControl")], compat=True)
    assert "AdminsPresent" not in ids


def test_name_from_raw(spark):
    rows = [("\\\\f\\s\\x", None, "S-1-5-21-6", "Modify", False, '{"name": "Everyone"}')]
    assert "EveryoneModify" in rule_ids(spark, rows)


def _severity_ruleset():
    return {"rules": [{"id": "L", "severity": "low"}, {"id": "M", "severity": "medium"},
                      {"id": "H", "severity": "high"}]}


def test_min_severity_medium(spark):
    ids = rule_ids(spark, [("\\\\f\\s\\x", "A", "S-1", "Read")], ruleset=_severity_ruleset(), min_severity="medium")
    assert ids == {"M", "H"}


def test_min_severity_low(spark):
    rs = {"rules": [{"id": "L", "severity": "low"}, {"id": "M", "severity": "medium"}]}
    ids = rule_ids(spark, [("\\\\f\\s\\x", "A", "S-1", "Read")], ruleset=rs, min_severity="low")
    assert ids == {"L", "M"}


def test_pattern_classification():
    rs = load_ruleset()
    kinds = {p.text: p.kind for p in rs.admin_identities}
    assert kinds["Administrators"] == "regex"
    assert kinds["*-admins"] == "wildcard"
    own = compile_ruleset({"admin_identities": ["EXAMPLE\\Global-Ops", "EXAMPLE\\ops-*"]})
    assert [p.kind for p in own.admin_identities] == ["contains", "wildcard"]  # \G is not a valid escape
    svc = {p.text: p.kind for p in rs.rule("ServiceAccountFullControl").identity_patterns}
    assert svc == {"*$": "wildcard", "*svc*": "wildcard", "*service*": "wildcard"}


def test_ace_inherited_is_parsed_not_truthy():
    rs = load_ruleset({"rules": [{"id": "x", "ace_inherited": "false"}]})
    assert rs.rules[0].ace_inherited is False


def test_rows_are_not_shuffled_for_the_folder_count(spark, tmp_path):
    # the folder count takes part in the rules without moving the rows, and only names that repeat are joined
    rows = [(f"f{i % 3}", f"n{i}", f"s{i}", "Read") for i in range(30)] + [("hot", "same", "s", "Read")] * 101 + [(None, "x", None, "Read")] * 2
    path = str(tmp_path / "aces")
    ace_df(spark, rows).write.parquet(path)
    aces = spark.read.parquet(path)
    found = apply_rules(aces, load_ruleset())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {k: n for k, n in found.where("rule_id in ('AclTooManyAces', 'DuplicateAceEntries')").groupBy("rule_id", "folder_path").count()
           .select("rule_id", "folder_path", "count").rdd.map(lambda r: ((r[0], r[1]), r[2])).collect()}
    assert got == {("AclTooManyAces", "hot"): 101, ("DuplicateAceEntries", "hot"): 101, ("DuplicateAceEntries", ""): 2}
    lazy = apply_rules(aces, load_ruleset(), counts_first=False)
    assert sorted(map(str, lazy.collect())) == sorted(map(str, found.collect()))
