"""Catalogue: identity graph, blast radius, effective access."""

from __future__ import annotations

from pyspark.sql import functions as F

from permscope.operators import access as AC
from permscope.operators import identity as ID
from permscope.operators import rules as RU
from permscope.plans.q_fingerprints import FINDINGS, LINES, OBJECT_ACL
from permscope.plans.q_rules import rules_oracle
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx
from permscope.sources.ruleset import load_ruleset

DEFAULT = load_ruleset()

CLOSURE = """
SELECT snapshot_id, member_sid, group_sid FROM edges
UNION
SELECT c.snapshot_id, c.member_sid, e.group_sid FROM cl c
JOIN edges e ON c.group_sid = e.member_sid AND c.snapshot_id = e.snapshot_id"""

CLOSURE_B = CLOSURE.replace("FROM edges", "FROM edges_b").replace("JOIN edges e", "JOIN edges_b e") \
    .replace("FROM cl c", "FROM clb c")

_RANK = """(CASE WHEN regexp_matches(lower(COALESCE(ace_mask, '')), 'full|generic_all')
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 268435456) <> 0
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 2032127) = 2032127 THEN 3
       WHEN regexp_matches(lower(COALESCE(ace_mask, '')), 'write|modify|take.?own|change.?perm')
            OR (COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) & 1073741846) <> 0 THEN 2
       WHEN contains(lower(COALESCE(ace_mask, '')), 'read') OR COALESCE(TRY_CAST(trim(ace_mask) AS BIGINT), 0) <> 0 THEN 1
       ELSE 0 END)"""
_BUCKET = ("CASE {r} WHEN 3 THEN 'fullcontrol' WHEN 2 THEN 'write' WHEN 1 THEN 'read' ELSE 'none' END")


def _closure(spark, sf, snapshot="a"):
    return ID.membership_closure(fx.membership_edges(spark, sf, snapshot))


@register("principals", "2.11", oracle("SELECT * FROM principals", "principals"))
def q_principals(spark, sf):
    return fx.principals(spark, sf)


@register("membership_edges", "2.11", oracle("SELECT DISTINCT * FROM edges", "edges"))
def q_membership_edges(spark, sf):
    return fx.membership_edges(spark, sf).distinct()


@register("membership_closure", "2.11", oracle(
    "SELECT * FROM cl WHERE member_sid <> group_sid", "edges", recursive=True, cl=CLOSURE))
def q_membership_closure(spark, sf):
    return _closure(spark, sf)


@register("membership_closure_updated", "2.11", oracle(
    "SELECT DISTINCT member_sid, group_sid FROM clb", "edges_b", recursive=True, clb=CLOSURE_B))
def q_membership_closure_updated(spark, sf):
    # snapshot A's closure brought up to date with snapshot B's edges
    before, after = fx.membership_edges(spark, sf, "a"), fx.membership_edges(spark, sf, "b")
    return ID.update_closure(ID.membership_closure(before, include_self=True), before, after)


# breadth first: each round takes the smallest chain of the pairs it reaches first
_CHAINS = """
SELECT snapshot_id, member_sid, group_sid, 1 AS depth, [group_sid] AS chain FROM edges WHERE member_sid <> group_sid
UNION ALL
SELECT c.snapshot_id, c.member_sid, e.group_sid, c.depth + 1, min(list_append(c.chain, e.group_sid))
FROM ch c JOIN edges e ON e.member_sid = c.group_sid AND e.snapshot_id = c.snapshot_id
WHERE e.group_sid <> c.member_sid AND NOT list_contains(c.chain, e.group_sid)
GROUP BY c.snapshot_id, c.member_sid, e.group_sid, c.depth"""


@register("membership_chains", "2.11", oracle("""
SELECT snapshot_id, member_sid, group_sid, depth, array_to_string(chain, ' > ') AS chain FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id, member_sid, group_sid ORDER BY depth, chain) AS k FROM ch)
WHERE k = 1""", "edges", recursive=True, ch=_CHAINS))
def q_membership_chains(spark, sf):
    out = ID.membership_chains(fx.membership_edges(spark, sf))
    return out.withColumn("chain", F.array_join("chain", " > "))


@register("group_members", "2.11", oracle(
    "SELECT snapshot_id, group_sid, COUNT(*) AS members FROM cl WHERE member_sid <> group_sid GROUP BY 1, 2",
    "edges", recursive=True, cl=CLOSURE))
def q_group_members(spark, sf):
    return ID.group_members(_closure(spark, sf)).groupBy("snapshot_id", "group_sid").agg(
        F.count(F.lit(1)).alias("members"))


@register("acl_principal_scope", "2.11", oracle("""
SELECT ace_sid, MIN(ace_name) AS ace_name, COUNT(*) AS ace_count FROM aces
WHERE ace_sid IS NOT NULL AND ace_sid <> '' GROUP BY ace_sid""", "aces"))
def q_acl_principal_scope(spark, sf):
    return ID.acl_principal_scope(fx.aces(spark, sf))


_BOTH = "SELECT * FROM principals UNION ALL SELECT * FROM principals_b"


def _both_principals(spark, sf):
    return fx.principals(spark, sf, "a").unionByName(fx.principals(spark, sf, "b"))


@register("sid_resolution", "2.4", oracle("""
SELECT n.snapshot_id, s.ace_sid, s.ace_name, s.ace_count, p.samaccountname, p.principal_type, p.enabled,
       p.principal_type IS NOT NULL AS resolved
FROM (SELECT ace_sid, MIN(ace_name) AS ace_name, COUNT(*) AS ace_count FROM aces
      WHERE ace_sid IS NOT NULL AND ace_sid <> '' GROUP BY ace_sid) s
CROSS JOIN (SELECT DISTINCT snapshot_id FROM both_snapshots) n
LEFT JOIN both_snapshots p ON p.sid = s.ace_sid AND p.snapshot_id = n.snapshot_id""", "aces", "principals", "principals_b", both_snapshots=_BOTH))
def q_sid_resolution(spark, sf):
    return ID.sid_resolution(fx.aces(spark, sf), _both_principals(spark, sf))


@register("unresolved_sids", "2.4", oracle("""
SELECT n.snapshot_id, ace_sid, MIN(ace_name) AS ace_name, COUNT(*) AS ace_count
FROM aces CROSS JOIN (SELECT DISTINCT snapshot_id FROM both_snapshots) n
WHERE ace_sid IS NOT NULL AND ace_sid <> '' AND (n.snapshot_id, ace_sid) NOT IN (SELECT (snapshot_id, sid) FROM both_snapshots)
GROUP BY n.snapshot_id, ace_sid""", "aces", "principals", "principals_b", both_snapshots=_BOTH))
def q_unresolved_sids(spark, sf):
    return ID.unresolved_sids(fx.aces(spark, sf), _both_principals(spark, sf))


@register("rights_bucket", "2.11", oracle(f"""
SELECT {_BUCKET.format(r=_RANK)} AS rights_bucket, COUNT(*) AS ace_count FROM aces GROUP BY 1""", "aces"))
def q_rights_bucket(spark, sf):
    from permscope.functions.masks import rights_bucket
    return (fx.aces(spark, sf).groupBy(rights_bucket("ace_mask").alias("rights_bucket"))
            .agg(F.count(F.lit(1)).alias("ace_count")))


BLAST = """
SELECT p.snapshot_id, p.sid, p.principal_type,
       CAST(CASE WHEN p.principal_type IN ('user', 'service') THEN CASE WHEN p.enabled THEN 1 ELSE 0 END
                 ELSE COALESCE(m.members, 0) END AS BIGINT) AS blast_radius
FROM principals p
LEFT JOIN (SELECT c.snapshot_id, c.group_sid, COUNT(DISTINCT c.member_sid) AS members
           FROM cl c JOIN principals u ON u.sid = c.member_sid AND u.snapshot_id = c.snapshot_id
           WHERE c.member_sid <> c.group_sid AND u.principal_type IN ('user', 'service') AND u.enabled
           GROUP BY 1, 2) m ON m.snapshot_id = p.snapshot_id AND m.group_sid = p.sid
UNION ALL
SELECT snapshot_id, unnest(['S-1-1-0', 'S-1-5-11', 'S-1-5-32-545']) AS sid, 'well-known', n
FROM (SELECT snapshot_id, CAST(COUNT(*) AS BIGINT) AS n FROM principals
      WHERE principal_type IN ('user', 'service') AND enabled GROUP BY snapshot_id)"""


@register("blast_radius", "2.11", oracle("SELECT * FROM br", "edges", "principals", recursive=True,
                                         cl=CLOSURE, br=BLAST))
def q_blast_radius(spark, sf):
    return ID.blast_radius(fx.principals(spark, sf), _closure(spark, sf))


@register("top_blast_radius_writes", "2.11", oracle(f"""
SELECT a.folder_path, a.ace_name, a.ace_sid, a.ace_mask, {_BUCKET.format(r='a.rk')} AS rights_bucket,
       b.principal_type, COALESCE(b.blast_radius, 0) AS blast_radius
FROM (SELECT *, {_RANK} AS rk FROM aces) a LEFT JOIN br b ON b.sid = a.ace_sid AND b.snapshot_id = 'snap-a'
WHERE a.rk >= 2 AND lower(COALESCE(a.ace_type, 'allow')) <> 'deny'
ORDER BY blast_radius DESC, a.folder_path ASC NULLS LAST, a.ace_sid ASC NULLS LAST, a.ace_mask ASC NULLS LAST,
         a.ace_name ASC NULLS LAST
LIMIT 20""", "aces", "edges", "principals", recursive=True, cl=CLOSURE, br=BLAST))
def q_top_blast_radius_writes(spark, sf):
    return ID.top_blast_radius_writes(fx.aces(spark, sf), fx.principals(spark, sf), _closure(spark, sf), "snap-a")


@register("finding_principal", "2.11", oracle("""
SELECT m.*, p.principal_type, p.samaccountname AS principal_name
FROM m LEFT JOIN principals p ON p.sid = m.ace_sid""", "principals", m=rules_oracle(DEFAULT)))
def q_finding_principal(spark, sf):
    return ID.finding_principal(RU.apply_rules(fx.aces(spark, sf), DEFAULT), fx.principals(spark, sf), "snap-a")


_WK = "('S-1-1-0', 'S-1-5-11', 'S-1-5-32-545')"


@register("security_context", "2.11", oracle("""
SELECT snapshot_id, user_sid, context_sid, MIN(via) AS via FROM (
  SELECT snapshot_id, sid AS user_sid, sid AS context_sid, 'self' AS via FROM users
  UNION ALL
  SELECT c.snapshot_id, member_sid, group_sid, 'group' FROM cl c JOIN users u ON u.sid = c.member_sid AND u.snapshot_id = c.snapshot_id
  WHERE member_sid <> group_sid
  UNION ALL SELECT snapshot_id, sid, unnest(['S-1-1-0', 'S-1-5-11', 'S-1-5-32-545']), 'well-known' FROM users
) GROUP BY 1, 2, 3""", "edges", "principals", recursive=True, cl=CLOSURE,
    users="SELECT DISTINCT snapshot_id, sid FROM principals WHERE principal_type IN ('user', 'service')"))
def q_security_context(spark, sf):
    users = fx.principals(spark, sf).where(AC.is_user(F.col("principal_type")))
    return ID.security_context(users, _closure(spark, sf))


def _judged(src: str, keys: str) -> str:
    """Effective rank and evidence of each group of ``src`` rows (t, inh, rk, s, m, v)."""
    return f"""
SELECT {keys}, greatest(least(ea, ed - 1), least(ia, ed - 1, idn - 1)) AS eff,
       CASE WHEN least(ea, ed - 1) >= least(ia, ed - 1, idn - 1) THEN ev_e ELSE ev_i END AS ev, approx FROM (
  SELECT {keys},
    COALESCE(MAX(CASE WHEN t <> 'deny' AND NOT inh THEN rk END), 0) AS ea,
    COALESCE(MAX(CASE WHEN t <> 'deny' AND inh THEN rk END), 0) AS ia,
    COALESCE(MIN(CASE WHEN t = 'deny' AND NOT inh AND rk > 0 THEN rk END), 4) AS ed,
    COALESCE(MIN(CASE WHEN t = 'deny' AND inh AND rk > 0 THEN rk END), 4) AS idn,
    bool_or(t NOT IN ('allow', 'deny')) AS approx,
    MAX({{'k': rk, 's': s, 'm': m, 'v': v}}) FILTER (WHERE t <> 'deny' AND NOT inh) AS ev_e,
    MAX({{'k': rk, 's': s, 'm': m, 'v': v}}) FILTER (WHERE t <> 'deny' AND inh) AS ev_i
  FROM ({src}) GROUP BY {keys})"""


def _access_ctes(aces: str = "aces", principals: str = "principals", cl: str = "cl", tag: str = "") -> dict[str, str]:
    """CTEs that evaluate every (holder, ACL) on its whole set of ACL lines."""
    al, ug, cls, usr, cg, defs, w, g, u = (f"{n}{tag}" for n in ("al", "ug", "cls", "usr", "cg", "defs", "w", "g", "u"))
    md5s = ", ".join(f"sum(('0x' || substr(md5(group_sid), {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(4))
    cols = "al.t, al.inh, al.rk, al.ace_sid AS s, al.ace_mask AS m"
    return {
        f"lines{tag}": LINES.replace("FROM aces", f"FROM {aces}"),
        f"oa{tag}": OBJECT_ACL.replace("FROM lines", f"FROM lines{tag}"),
        defs: f"SELECT run_id, acl_fingerprint, COUNT(*) AS folders FROM oa{tag} GROUP BY 1, 2",
        al: f"""SELECT DISTINCT oa.run_id, oa.acl_fingerprint, p.ace_sid, p.ace_mask, p.ace_inherited AS inh,
       CASE WHEN p.ace_type = '' THEN 'allow' ELSE p.ace_type END AS t, {_RANK.replace('ace_mask', 'p.ace_mask')} AS rk
FROM lines{tag} p JOIN oa{tag} oa ON p.run_id = oa.run_id AND p.folder_path IS NOT DISTINCT FROM oa.folder_path""",
        ug: f"""SELECT c.snapshot_id, c.member_sid AS user_sid, c.group_sid FROM {cl} c
JOIN {principals} p ON p.sid = c.member_sid AND p.snapshot_id = c.snapshot_id
WHERE c.member_sid <> c.group_sid AND p.principal_type IN ('user', 'service') AND c.group_sid IN (SELECT ace_sid FROM {al})""",
        cls: f"SELECT snapshot_id, user_sid, sha256(concat_ws(':', count(*)::VARCHAR, {md5s})) AS class_id FROM {ug} GROUP BY 1, 2",
        usr: f"""SELECT p.snapshot_id, p.sid AS user_sid, COALESCE(class_id, 'none') AS class_id
FROM {principals} p LEFT JOIN {cls} c ON c.user_sid = p.sid AND c.snapshot_id = p.snapshot_id WHERE p.principal_type IN ('user', 'service')""",
        cg: f"SELECT DISTINCT c.snapshot_id, c.class_id, g.group_sid FROM {cls} c JOIN {ug} g USING (snapshot_id, user_sid)",
        w: _judged(f"SELECT run_id, acl_fingerprint, {cols}, 'well-known' AS v FROM {al} al WHERE ace_sid IN {_WK}", "run_id, acl_fingerprint"),
        f"gk{tag}": f"SELECT DISTINCT al.run_id, cg.snapshot_id, cg.class_id, al.acl_fingerprint FROM {al} al JOIN {cg} cg ON cg.group_sid = al.ace_sid",
        g: _judged(f"""
SELECT k.run_id, k.snapshot_id, k.class_id, k.acl_fingerprint, {cols}, 'well-known' AS v
FROM gk{tag} k JOIN {al} al USING (run_id, acl_fingerprint) WHERE al.ace_sid IN {_WK}
UNION ALL
SELECT al.run_id, cg.snapshot_id, cg.class_id, al.acl_fingerprint, {cols}, 'group' FROM {al} al JOIN {cg} cg ON cg.group_sid = al.ace_sid""",
                   "run_id, snapshot_id, class_id, acl_fingerprint"),
        f"uk{tag}": f"""SELECT DISTINCT al.run_id, x.snapshot_id, x.user_sid, x.class_id, al.acl_fingerprint
FROM {al} al JOIN {usr} x ON x.user_sid = al.ace_sid""",
        u: _judged(f"""
SELECT k.run_id, k.snapshot_id, k.user_sid, k.class_id, k.acl_fingerprint, {cols}, 'well-known' AS v
FROM uk{tag} k JOIN {al} al USING (run_id, acl_fingerprint) WHERE al.ace_sid IN {_WK}
UNION ALL
SELECT k.run_id, k.snapshot_id, k.user_sid, k.class_id, k.acl_fingerprint, {cols}, 'self'
FROM uk{tag} k JOIN {al} al ON al.run_id = k.run_id AND al.acl_fingerprint = k.acl_fingerprint AND al.ace_sid = k.user_sid
UNION ALL
SELECT k.run_id, k.snapshot_id, k.user_sid, k.class_id, k.acl_fingerprint, {cols}, 'group'
FROM uk{tag} k JOIN {cg} cg ON cg.snapshot_id = k.snapshot_id AND cg.class_id = k.class_id
JOIN {al} al ON al.run_id = k.run_id AND al.acl_fingerprint = k.acl_fingerprint AND al.ace_sid = cg.group_sid""",
                   "run_id, snapshot_id, user_sid, class_id, acl_fingerprint"),
    }


def _holder_sql(kind: str, holder: str, snapshot: str, src: str, below: str) -> str:
    return f"""
SELECT x.run_id, {snapshot} AS snapshot_id, '{kind}' AS holder_kind, {holder} AS holder, x.acl_fingerprint, d.folders,
       x.eff AS rights_rank, {below} AS rank_below, {_BUCKET.format(r='x.eff')} AS rights_bucket,
       CASE WHEN x.eff > 0 THEN x.ev.s END AS matched_sid, CASE WHEN x.eff > 0 THEN x.ev.m END AS matched_mask,
       CASE WHEN x.eff > 0 THEN x.ev.v END AS via, CASE WHEN x.approx THEN 'approximate' ELSE 'exact' END AS semantics,
       'snapshot, folder-level rights only' AS scope
FROM {src} x JOIN defs d USING (run_id, acl_fingerprint)
LEFT JOIN w ON w.run_id = x.run_id AND w.acl_fingerprint = x.acl_fingerprint"""


_ACCESS = (_holder_sql("everyone", "'everyone'", "NULL::VARCHAR", "w", "0").replace("FROM w x", "FROM w AS x")
           + "\nUNION ALL" + _holder_sql("class", "x.class_id", "x.snapshot_id", "g", "COALESCE(w.eff, 0)")
           + "\nUNION ALL" + _holder_sql("user", "x.user_sid", "x.snapshot_id", "u", "COALESCE(g.eff, w.eff, 0)")
           + """
LEFT JOIN g ON g.run_id = x.run_id AND g.snapshot_id = x.snapshot_id AND g.class_id = x.class_id AND g.acl_fingerprint = x.acl_fingerprint""")


def _summary_sql(tag: str = "") -> str:
    """Folders of each user and bucket: all ACLs of the class, those with own lines judged with them."""
    return f"""
SELECT run_id, snapshot_id, user_sid, rights_bucket, SUM(n)::BIGINT AS folders FROM (
  SELECT r.run_id, x.snapshot_id, x.user_sid, b.rights_bucket, b.k, COALESCE(c.n, 0) AS n
  FROM usr{tag} x CROSS JOIN (SELECT DISTINCT run_id FROM defs{tag}) r
  CROSS JOIN (VALUES ('read', 1), ('write', 2), ('fullcontrol', 3)) b(rights_bucket, k)
  LEFT JOIN (SELECT run_id, snapshot_id, class_id, eff, SUM(folders) AS n FROM (
      SELECT w.run_id, c.snapshot_id, c.class_id, w.acl_fingerprint, w.eff
      FROM w{tag} w CROSS JOIN (SELECT DISTINCT snapshot_id, class_id FROM usr{tag}) c
      ANTI JOIN g{tag} g ON g.run_id = w.run_id AND g.snapshot_id = c.snapshot_id AND g.class_id = c.class_id AND g.acl_fingerprint = w.acl_fingerprint
      UNION ALL SELECT run_id, snapshot_id, class_id, acl_fingerprint, eff FROM g{tag}) JOIN defs{tag} USING (run_id, acl_fingerprint)
    GROUP BY 1, 2, 3, 4) c ON c.run_id = r.run_id AND c.snapshot_id = x.snapshot_id AND c.class_id = x.class_id AND c.eff = b.k
  UNION ALL
  SELECT u.run_id, u.snapshot_id, u.user_sid, b.rights_bucket, b.k,
         d.folders * ((u.eff = b.k)::INT - (COALESCE(g.eff, w.eff, 0) = b.k)::INT)
  FROM u{tag} u JOIN defs{tag} d USING (run_id, acl_fingerprint)
  LEFT JOIN g{tag} g ON g.run_id = u.run_id AND g.snapshot_id = u.snapshot_id AND g.class_id = u.class_id AND g.acl_fingerprint = u.acl_fingerprint
  LEFT JOIN w{tag} w ON w.run_id = u.run_id AND w.acl_fingerprint = u.acl_fingerprint
  CROSS JOIN (VALUES ('read', 1), ('write', 2), ('fullcontrol', 3)) b(rights_bucket, k))
GROUP BY 1, 2, 3, 4"""


def _access(spark, sf, snapshot="a"):
    return AC.access_table(fx.aces(spark, sf, snapshot), fx.principals(spark, sf, snapshot), _closure(spark, sf, snapshot))


@register("effective_access", "2.11", oracle(_ACCESS, "aces", "edges", "principals", recursive=True, cl=CLOSURE, **_access_ctes()))
def q_effective_access(spark, sf):
    # every user principal, by class and ACL
    return _access(spark, sf).rows


@register("effective_access_summary", "2.11", oracle(_summary_sql(), "aces", "edges", "principals", recursive=True,
                                                     cl=CLOSURE, **_access_ctes()))
def q_effective_access_summary(spark, sf):
    return AC.access_summary(_access(spark, sf))


# users by the classes they had and have; folders by their ACLs; ranks of each level before and after
_DIFF = {
    "who": "SELECT y.user_sid, x.class_id AS ca, y.class_id AS cb FROM usr2 y LEFT JOIN usr x ON x.user_sid = y.user_sid",
    "moves": "SELECT DISTINCT ca, cb FROM who",
    "fo": """SELECT b.folder_path, a.acl_fingerprint AS fa, b.acl_fingerprint AS fb
FROM oa2 b LEFT JOIN oa a ON a.folder_path IS NOT DISTINCT FROM b.folder_path""",
    "lv0": """SELECT fo.*, COALESCE(x.eff, 0) AS ea, COALESCE(y.eff, 0) AS eb, y.ev AS eev
FROM fo LEFT JOIN w x ON x.acl_fingerprint = fa LEFT JOIN w2 y ON y.acl_fingerprint = fb""",
    "k1": """SELECT folder_path, ca, cb FROM fo JOIN g ON acl_fingerprint = fa JOIN moves ON ca = class_id
UNION SELECT folder_path, ca, cb FROM fo JOIN g2 ON acl_fingerprint = fb JOIN moves ON cb = class_id""",
    "lv1": """SELECT f.*, k.ca, k.cb, CASE WHEN k.ca IS NULL THEN 0 ELSE COALESCE(x.eff, f.ea) END AS ra, COALESCE(y.eff, f.eb) AS rb,
       CASE WHEN y.eff IS NULL THEN f.eev ELSE y.ev END AS rev
FROM k1 k JOIN lv0 f ON f.folder_path IS NOT DISTINCT FROM k.folder_path
LEFT JOIN g x ON x.acl_fingerprint = f.fa AND x.class_id = k.ca LEFT JOIN g2 y ON y.acl_fingerprint = f.fb AND y.class_id = k.cb""",
    "k2": """SELECT folder_path, user_sid FROM fo JOIN u ON acl_fingerprint = fa
UNION SELECT folder_path, user_sid FROM fo JOIN u2 ON acl_fingerprint = fb""",
    "lv2": """SELECT k.folder_path, k.user_sid, CASE WHEN n.ca IS NULL THEN 0 ELSE COALESCE(x.eff, c.ra, f.ea) END AS sa,
       COALESCE(y.eff, c.rb, f.eb) AS sb, CASE WHEN y.eff IS NOT NULL THEN y.ev WHEN c.rb IS NOT NULL THEN c.rev ELSE f.eev END AS sev,
       COALESCE(c.rb > c.ra, f.eb > CASE WHEN n.ca IS NULL THEN 0 ELSE f.ea END) AS below
FROM k2 k JOIN who n ON n.user_sid = k.user_sid JOIN lv0 f ON f.folder_path IS NOT DISTINCT FROM k.folder_path
LEFT JOIN lv1 c ON c.folder_path IS NOT DISTINCT FROM k.folder_path AND c.ca IS NOT DISTINCT FROM n.ca AND c.cb = n.cb
LEFT JOIN u x ON x.acl_fingerprint = f.fa AND x.user_sid = k.user_sid LEFT JOIN u2 y ON y.acl_fingerprint = f.fb AND y.user_sid = k.user_sid""",
    "rises": """
SELECT 'everyone' AS holder_kind, CASE WHEN n.fresh THEN 'new' ELSE 'everyone' END AS holder, folder_path,
       CASE WHEN n.fresh THEN 0 ELSE ea END AS a, eb AS b, eev AS ev, false AS below
FROM lv0 CROSS JOIN (SELECT DISTINCT ca IS NULL AS fresh FROM who) n
UNION ALL
SELECT 'class', COALESCE(ca, 'new') || '>' || cb, folder_path, ra, rb, rev, eb > CASE WHEN ca IS NULL THEN 0 ELSE ea END FROM lv1
UNION ALL
SELECT 'user', user_sid, folder_path, sa, sb, sev, below FROM lv2""",
}


@register("effective_access_diff", "2.11", oracle(f"""
SELECT holder_kind, holder, folder_path, {_BUCKET.format(r='a')} AS bucket_before, {_BUCKET.format(r='b')} AS bucket_after, b > a AS rose,
       CASE WHEN b > 0 THEN ev.s END AS matched_sid, CASE WHEN b > 0 THEN ev.m END AS matched_mask
FROM rises WHERE b > a OR below""",
    "aces", "aces_b", "edges", "edges_b", "principals", "principals_b", recursive=True, cl=CLOSURE, clb=CLOSURE_B,
    **_access_ctes(), **_access_ctes("aces_b", "principals_b", "clb", "2"), **_DIFF))
def q_effective_access_diff(spark, sf):
    # the accesses of both runs, joined folder by folder
    return AC.access_diff(_access(spark, sf, "a"), _access(spark, sf, "b"))


def _radius_ctes(service: bool) -> dict[str, str]:
    kinds = "('user', 'service')" if service else "('user')"
    return {
        "lines": LINES, "oa": OBJECT_ACL,
        "counted": f"SELECT sid FROM principals WHERE enabled AND principal_type IN {kinds}",
        "grants": f"""SELECT p.folder_path, p.ace_sid, MAX({_RANK.replace('ace_mask', 'p.ace_mask')}) AS rk FROM lines p
WHERE p.ace_type <> 'deny' GROUP BY 1, 2 HAVING rk > 0""",
        # users with the same groups count together; folders x users would be too many rows
        "uc": """SELECT u.sid, COALESCE(k.key, '') AS key FROM counted u LEFT JOIN (
  SELECT member_sid, string_agg(group_sid, ',' ORDER BY group_sid) AS key FROM cl WHERE member_sid <> group_sid GROUP BY 1) k
  ON k.member_sid = u.sid""",
        "kg": "SELECT key, COUNT(*) AS n, unnest(string_split(key, ',')) AS group_sid FROM uc WHERE key <> '' GROUP BY key",
        "rc": "SELECT g.folder_path, kg.key, ANY_VALUE(kg.n) AS n, MAX(g.rk) AS rk FROM grants g JOIN kg ON kg.group_sid = g.ace_sid GROUP BY 1, 2",
        "named": """SELECT folder_path, SUM(n1) AS n1, SUM(n2) AS n2 FROM (
  SELECT folder_path, n AS n1, CASE WHEN rk >= 2 THEN n ELSE 0 END AS n2 FROM rc
  UNION ALL
  SELECT g.folder_path, (COALESCE(rc.rk, 0) < 1)::INT, (g.rk >= 2 AND COALESCE(rc.rk, 0) < 2)::INT
  FROM grants g JOIN uc ON uc.sid = g.ace_sid
  LEFT JOIN rc ON rc.folder_path IS NOT DISTINCT FROM g.folder_path AND rc.key = uc.key) GROUP BY 1""",
        "every": f"SELECT folder_path, MAX(rk) AS rk FROM grants WHERE ace_sid IN {_WK} GROUP BY 1",
        "whole": "SELECT COUNT(*) AS n FROM counted",
    }


_FOLDER_RADIUS = """
SELECT o.run_id, COALESCE(o.folder_path, '') AS folder_path,
       (CASE WHEN e.rk >= 1 THEN (SELECT n FROM whole) ELSE COALESCE(n.n1, 0) END)::BIGINT AS folder_blast_radius_read,
       (CASE WHEN e.rk >= 2 THEN (SELECT n FROM whole) ELSE COALESCE(n.n2, 0) END)::BIGINT AS folder_blast_radius_write
FROM oa o LEFT JOIN named n ON n.folder_path IS NOT DISTINCT FROM o.folder_path
LEFT JOIN every e ON e.folder_path IS NOT DISTINCT FROM o.folder_path"""


def _findings_radius_sql(service: bool) -> str:
    br = BLAST if service else BLAST.replace("('user', 'service') THEN CASE WHEN p.enabled THEN 1", "('user', 'service') THEN CASE WHEN p.enabled AND p.principal_type = 'user' THEN 1") \
        .replace("u.principal_type IN ('user', 'service') AND u.enabled", "u.principal_type = 'user' AND u.enabled") \
        .replace("WHERE principal_type IN ('user', 'service') AND enabled GROUP BY", "WHERE principal_type = 'user' AND enabled GROUP BY")
    return oracle(f"""
SELECT f.*, p.principal_type, p.samaccountname AS principal_name,
       (CASE WHEN f.rk >= 1 THEN COALESCE(b.blast_radius, 0) ELSE 0 END)::BIGINT AS blast_radius_read,
       (CASE WHEN f.rk >= 2 THEN COALESCE(b.blast_radius, 0) ELSE 0 END)::BIGINT AS blast_radius_write,
       r.folder_blast_radius_read, r.folder_blast_radius_write
FROM (SELECT *, {_RANK} AS rk FROM fs) f LEFT JOIN br b ON b.sid = f.ace_sid LEFT JOIN principals p ON p.sid = f.ace_sid
LEFT JOIN fr r ON r.folder_path = f.folder_path""".replace("SELECT f.*,", "SELECT f.* EXCLUDE (rk),"),
                  "aces", "edges", "principals", recursive=True, cl=CLOSURE, br=br, **_radius_ctes(service), fr=_FOLDER_RADIUS,
                  m=rules_oracle(DEFAULT), fs=FINDINGS)


def _findings_radius(spark, sf, exclude_service):
    from permscope.operators.fingerprint import findings_standard

    aces = fx.aces(spark, sf)
    found = findings_standard(RU.apply_rules(aces, DEFAULT, keep=("run_id",)), aces)
    return AC.findings_with_radius(found, aces, fx.principals(spark, sf), _closure(spark, sf), "snap-a", exclude_service)


@register("findings_blast_radius", "2.11", _findings_radius_sql(True))
def q_findings_blast_radius(spark, sf):
    return _findings_radius(spark, sf, False)


@register("findings_blast_radius_humans", "2.11", _findings_radius_sql(False))
def q_findings_blast_radius_humans(spark, sf):
    return _findings_radius(spark, sf, True)
