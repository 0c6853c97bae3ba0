"""Catalogue: run-to-run drift (run A vs run B of the derived estate)."""

from __future__ import annotations

from pyspark.sql import functions as F

from permscope.functions.predicates import BROAD_IDENTITIES
from permscope.operators import drift as DR
from permscope.operators import rules as RU
from permscope.plans import sqlparts as S
from permscope.plans.q_fingerprints import LINES, OBJECT_ACL
from permscope.plans.q_identity import _RANK
from permscope.plans.q_rules import rules_oracle
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx
from permscope.sources.ruleset import load_ruleset

DEFAULT = load_ruleset()
MA = rules_oracle(DEFAULT)
MB = rules_oracle(DEFAULT, src="aces_b")
KEY = "rule_id, folder_path, ace_name, ace_sid, ace_mask, ace_inherited, severity"

LINES_B = LINES.replace(" FROM aces", " FROM aces_b")
OBJECT_ACL_B = OBJECT_ACL.replace("FROM lines ", "FROM lines_b ")


def _matches(spark, sf):
    return (RU.apply_rules(fx.aces(spark, sf, "a"), DEFAULT), RU.apply_rules(fx.aces(spark, sf, "b"), DEFAULT))


@register("findings_added", "2.8", oracle(f"SELECT DISTINCT {KEY} FROM mb EXCEPT SELECT DISTINCT {KEY} FROM ma",
                                          ma=MA, mb=MB))
def q_findings_added(spark, sf):
    return DR.findings_added(*_matches(spark, sf))


@register("findings_removed", "2.8", oracle(f"SELECT DISTINCT {KEY} FROM ma EXCEPT SELECT DISTINCT {KEY} FROM mb",
                                            ma=MA, mb=MB))
def q_findings_removed(spark, sf):
    return DR.findings_removed(*_matches(spark, sf))


@register("findings_persisting", "2.8", oracle(
    f"SELECT DISTINCT {KEY} FROM mb INTERSECT SELECT DISTINCT {KEY} FROM ma", ma=MA, mb=MB))
def q_findings_persisting(spark, sf):
    return DR.findings_persisting(*_matches(spark, sf))


@register("new_high_severity_findings", "2.11", oracle(
    f"SELECT * FROM (SELECT DISTINCT {KEY} FROM mb EXCEPT SELECT DISTINCT {KEY} FROM ma) WHERE lower(severity) = 'high'",
    ma=MA, mb=MB))
def q_new_high_severity_findings(spark, sf):
    return DR.new_high_severity_findings(*_matches(spark, sf))


_CHANGED = """
SELECT COALESCE(b.object_id, a.object_id) AS object_id, COALESCE(b.folder_path, a.folder_path) AS folder_path,
       a.acl_fingerprint AS old_fingerprint, b.acl_fingerprint AS new_fingerprint,
       CASE WHEN a.acl_fingerprint IS NULL THEN 'added' WHEN b.acl_fingerprint IS NULL THEN 'removed'
            ELSE 'changed' END AS change
FROM oa a FULL OUTER JOIN oa_b b ON a.object_id = b.object_id
WHERE a.acl_fingerprint IS DISTINCT FROM b.acl_fingerprint"""


@register("acl_changed_objects", "2.11", oracle("SELECT * FROM ch", "aces", "aces_b", lines=LINES, oa=OBJECT_ACL,
                                                lines_b=LINES_B, oa_b=OBJECT_ACL_B, ch=_CHANGED))
def q_acl_changed_objects(spark, sf):
    return DR.acl_changed_objects(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b"))


@register("run_diff", "2.4", oracle("SELECT change, COUNT(*) AS objects FROM ch GROUP BY change",
                                    "aces", "aces_b", lines=LINES, oa=OBJECT_ACL, lines_b=LINES_B,
                                    oa_b=OBJECT_ACL_B, ch=_CHANGED))
def q_run_diff(spark, sf):
    return DR.run_diff(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b"))


@register("membership_diff", "2.11", oracle("""
SELECT member_sid, group_sid, 'added' AS change FROM (
  SELECT member_sid, group_sid FROM edges_b EXCEPT SELECT member_sid, group_sid FROM edges)
UNION ALL
SELECT member_sid, group_sid, 'removed' FROM (
  SELECT member_sid, group_sid FROM edges EXCEPT SELECT member_sid, group_sid FROM edges_b)""", "edges", "edges_b"))
def q_membership_diff(spark, sf):
    return DR.membership_diff(fx.membership_edges(spark, sf, "a"), fx.membership_edges(spark, sf, "b"))


def _broad_sql(src: str) -> str:
    return f"""
SELECT COALESCE(folder_path, '') AS folder_path, COALESCE(NULLIF(ace_sid, ''), res_name) AS identity,
       res_name, ace_mask, rk
FROM (SELECT *, {S.res_name()} AS res_name, {_RANK} AS rk FROM {src})
WHERE {S.contains_any('res_name', BROAD_IDENTITIES)} AND {S.high_bitmask('ace_mask')}"""


_BROAD = dict(ba=_broad_sql("aces"), bb=_broad_sql("aces_b"))


@register("new_broad_aces", "2.11", oracle("""
SELECT DISTINCT b.folder_path, b.identity, b.res_name AS ace_name, b.ace_mask FROM bb b
WHERE NOT EXISTS (SELECT 1 FROM ba a WHERE a.folder_path = b.folder_path AND a.identity = b.identity)""",
    "aces", "aces_b", **_BROAD))
def q_new_broad_aces(spark, sf):
    return DR.new_broad_aces(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b"))


@register("new_broad_write_grants", "2.11", oracle("""
SELECT b.folder_path, b.identity, COALESCE(a.r, 0) AS rank_before, b.r AS rank_after
FROM (SELECT folder_path, identity, MAX(rk) AS r FROM bb GROUP BY 1, 2) b
LEFT JOIN (SELECT folder_path, identity, MAX(rk) AS r FROM ba GROUP BY 1, 2) a
  ON a.folder_path = b.folder_path AND a.identity = b.identity
WHERE b.r >= 2 AND b.r > COALESCE(a.r, 0)""", "aces", "aces_b", **_BROAD))
def q_new_broad_write_grants(spark, sf):
    return DR.new_broad_write_grants(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b"))


@register("mass_permission_change", "2.11", oracle("""
SELECT identity, CAST(SUM(g) AS BIGINT) AS folders_gained, CAST(SUM(l) AS BIGINT) AS folders_lost FROM (
  SELECT identity, 1 AS g, 0 AS l FROM (SELECT DISTINCT folder_path, identity FROM bb
                                        EXCEPT SELECT DISTINCT folder_path, identity FROM ba)
  UNION ALL
  SELECT identity, 0, 1 FROM (SELECT DISTINCT folder_path, identity FROM ba
                              EXCEPT SELECT DISTINCT folder_path, identity FROM bb))
GROUP BY identity HAVING SUM(g) + SUM(l) >= 10""", "aces", "aces_b", **_BROAD))
def q_mass_permission_change(spark, sf):
    return DR.mass_permission_change(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b"))


_SEV = "CASE lower(severity) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 0 END"


@register("risk_increased", "2.11", oracle(f"""
SELECT b.folder_path, COALESCE(a.r, 0) AS rank_before, b.r AS rank_after,
       COALESCE(a.n, 0) AS findings_before, b.n AS findings_after
FROM (SELECT folder_path, MAX({_SEV}) AS r, COUNT(*) AS n FROM mb GROUP BY 1) b
LEFT JOIN (SELECT folder_path, MAX({_SEV}) AS r, COUNT(*) AS n FROM ma GROUP BY 1) a USING (folder_path)
WHERE b.r > COALESCE(a.r, 0)""", ma=MA, mb=MB))
def q_risk_increased(spark, sf):
    return DR.risk_increased(*_matches(spark, sf))


_MOVED = """
SELECT * FROM aces_b WHERE folder_path IN (
  SELECT b.folder_path FROM oa_b b
  WHERE NOT EXISTS (SELECT 1 FROM oa a WHERE a.object_id = b.object_id AND a.acl_fingerprint = b.acl_fingerprint))
OR (folder_path IS NULL AND EXISTS (
  SELECT 1 FROM oa_b b WHERE b.folder_path IS NULL
  AND NOT EXISTS (SELECT 1 FROM oa a WHERE a.object_id = b.object_id AND a.acl_fingerprint = b.acl_fingerprint)))"""


@register("skip_unchanged", "2.10", rules_oracle(
    DEFAULT, src="moved", fixtures=("aces", "aces_b"), lines=LINES, oa=OBJECT_ACL, lines_b=LINES_B,
    oa_b=OBJECT_ACL_B, moved=_MOVED))
def q_skip_unchanged(spark, sf):
    # re-score only the objects whose ACL changed since run A
    return RU.apply_rules(DR.skip_unchanged(fx.aces(spark, sf, "a"), fx.aces(spark, sf, "b")), DEFAULT, counts_first=False)


def _store(spark, sf):
    """A store that saw run A, then run B: (store, ACLs of A, ACLs of B)."""
    import uuid

    from permscope.operators.score_store import ScoreStore
    from permscope.session import checkpoint_dir

    store = ScoreStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}", DEFAULT)
    before = store.update(fx.aces(spark, sf, "a"), batch="0001")
    return store, before, store.update(fx.aces(spark, sf, "b"), batch="0002")


@register("findings_from_store", "2.10", rules_oracle(DEFAULT, src="aces_b", fixtures=("aces_b",)))
def q_findings_from_store(spark, sf):
    # scored once per ACL; run B adds only what run A had not; equals a full scoring of run B
    store, _, after = _store(spark, sf)
    return store.findings(after).drop("run_id", "ruleset_version")


@register("score_store_batches", "2.10", oracle("""
SELECT '0001' AS batch, (SELECT COUNT(DISTINCT acl_fingerprint) FROM oa) AS fingerprints
UNION ALL
SELECT '0002', (SELECT COUNT(DISTINCT acl_fingerprint) FROM oa_b WHERE acl_fingerprint NOT IN (SELECT acl_fingerprint FROM oa))""",
    "aces", "aces_b", lines=LINES, oa=OBJECT_ACL, lines_b=LINES_B, oa_b=OBJECT_ACL_B))
def q_score_store_batches(spark, sf):
    store, _, _ = _store(spark, sf)
    return store.scored().groupBy("batch").agg(F.count("*").alias("fingerprints"))


@register("findings_drift_stored", "2.10", oracle(f"""
SELECT {{k}}, x.severity, 'run-b' AS run_id, 'added' AS change, '{DEFAULT.version}' AS ruleset_version
FROM (SELECT DISTINCT {{k}}, severity FROM mb) x ANTI JOIN ma USING ({{k}})
UNION ALL
SELECT {{k}}, x.severity, 'run-a', 'removed', '{DEFAULT.version}'
FROM (SELECT DISTINCT {{k}}, severity FROM ma) x ANTI JOIN mb USING ({{k}})""".format(k=", ".join(DR.FINDING_KEY)), ma=MA, mb=MB))
def q_findings_drift_stored(spark, sf):
    # from stored findings; only folders whose ACL changed are expanded
    store, before, after = _store(spark, sf)
    return store.drift(before, after)
