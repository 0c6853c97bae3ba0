"""Orientation numbers of FIXTURES.md §2 at sf0.01 (computed independently
when the derived estate was specified)."""

from helpers import SF_CHECK

from permscope.operators.patterns import excessive_ace_count
from permscope.operators.rules import apply_rules
from permscope.sources import fixtures as fx

EXPECTED_RULE_HITS = {
    "DomainUsersFullControl": 3692, "EveryoneModify": 1238, "NonAdminFullControl": 5102,
    "TakeOwnershipOrChangePerms": 10152, "AuthUsersBroadPerms": 2305, "ServiceAccountFullControl": 2413,
    "OrphanedSIDsFullControl": 5102, "ExternalPrincipalAccess": 1765, "SensitiveFoldersWrite": 10805,
    "AdminsPresent": 909,
}


def test_rule_hits_match_fixture_spec(spark):
    got = {r.rule_id: r["count"] for r in apply_rules(fx.aces(spark, SF_CHECK)).groupBy("rule_id").count().collect()}
    assert {k: got.get(k) for k in EXPECTED_RULE_HITS} == EXPECTED_RULE_HITS


def test_estate_shape_matches_fixture_spec(spark):
    a = fx.aces(spark, SF_CHECK)
    assert a.count() == 60000
    assert a.select("folder_path").distinct().count() == 13693 + 1     # + the null folder
    assert excessive_ace_count(a).count() == 22
