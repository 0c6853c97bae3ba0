"""Catalogue: objects, fingerprints, rules on definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from permscope.functions import sddl as SD
from permscope.operators import canonical as CA
from permscope.operators import fingerprint as FP
from permscope.plans import sqlparts as S
from permscope.plans.q_rules import rules_oracle
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx
from permscope.sources.ruleset import Ruleset, load_ruleset

DEFAULT = load_ruleset()

_NMASK = ("CASE WHEN ace_mask IS NULL THEN '' WHEN regexp_matches(ace_mask, '^0[xX]') THEN lower(ace_mask) "
          "ELSE ace_mask END")
_LINE = (f"concat_ws('|', COALESCE(ace_sid, ''), {S.res_name()}, lower(COALESCE(ace_type, '')), {_NMASK}, "
         "CASE WHEN COALESCE(ace_inherited, false) THEN '1' ELSE '0' END)")
LINES = (f"SELECT run_id, folder_path, COALESCE(ace_sid, '') AS ace_sid, {S.res_name()} AS ace_name, "
         f"lower(COALESCE(ace_type, '')) AS ace_type, {_NMASK} AS ace_mask, "
         f"COALESCE(ace_inherited, false) AS ace_inherited, owner, {_LINE} AS ace_line, "
         + ", ".join(f"('0x' || substr(md5({_LINE}), {1 + 8 * i}, 8))::BIGINT AS h{i}" for i in range(4))
         + " FROM aces")

_PARTS = "string_split(regexp_replace(folder_path, '^[\\\\]+|[\\\\]+$', '', 'g'), chr(92))"
_OK = f"(starts_with(folder_path, chr(92) || chr(92)) AND len({_PARTS}) >= 2)"
_FILER = f"CASE WHEN {_OK} THEN lower(split_part({_PARTS}[1], '.', 1)) END"
_SHARE = f"CASE WHEN {_OK} THEN lower({_PARTS}[2]) END"
_OBJID = f"sha256(concat_ws('|', COALESCE({_FILER}, ''), COALESCE({_SHARE}, ''), COALESCE(folder_path, '')))"

OBJECT_ACL = f"""
SELECT run_id, {_OBJID} AS object_id, folder_path,
       sha256(concat_ws(':', CAST(acl_ace_count AS VARCHAR), CAST(s0 AS VARCHAR), CAST(s1 AS VARCHAR),
                        CAST(s2 AS VARCHAR), CAST(s3 AS VARCHAR))) AS acl_fingerprint,
       acl_ace_count, owner
FROM (SELECT run_id, folder_path, COUNT(*) AS acl_ace_count, SUM(h0) AS s0, SUM(h1) AS s1, SUM(h2) AS s2,
             SUM(h3) AS s3, MIN(owner) AS owner FROM lines GROUP BY run_id, folder_path)"""


@register("object_acl", "2.11", oracle("SELECT * FROM oa", "aces", lines=LINES, oa=OBJECT_ACL))
def q_object_acl(spark, sf):
    return FP.object_acl(fx.aces(spark, sf))


@register("objects", "2.11", oracle(f"""
SELECT run_id, {_OBJID} AS object_id, {_FILER} AS server, {_SHARE} AS share, folder_path,
       len(list_filter(regexp_split_to_array(COALESCE(folder_path, ''), '[/\\\\]'), lambda x: x <> ''))::INTEGER AS depth,
       discovered_at, source_file
FROM (SELECT run_id, folder_path, MIN(collected_utc) AS discovered_at, MIN(source_file) AS source_file
      FROM aces GROUP BY run_id, folder_path)""", "aces"))
def q_objects(spark, sf):
    return FP.objects(fx.aces(spark, sf))


@register("acl_definitions", "2.11", oracle("""
SELECT run_id, acl_fingerprint, acl_ace_count, COUNT(*) AS object_count,
       'acl-canon-v1' AS canonicalization_version
FROM oa GROUP BY run_id, acl_fingerprint, acl_ace_count""", "aces", lines=LINES, oa=OBJECT_ACL))
def q_acl_definitions(spark, sf):
    return FP.acl_definitions(fx.aces(spark, sf))


@register("acl_ace_rows", "2.11", oracle("""
SELECT DISTINCT p.run_id, p.ace_line, p.ace_sid, p.ace_name, p.ace_type, p.ace_mask, p.ace_inherited, p.n,
       oa.acl_fingerprint
FROM (SELECT run_id, folder_path, ace_line, ace_sid, ace_name, ace_type, ace_mask, ace_inherited, COUNT(*) AS n
      FROM lines GROUP BY ALL) p
JOIN oa ON p.run_id = oa.run_id AND p.folder_path IS NOT DISTINCT FROM oa.folder_path""", "aces", lines=LINES, oa=OBJECT_ACL))
def q_acl_ace_rows(spark, sf):
    return FP.acl_ace_rows(fx.aces(spark, sf))


@register("unique_acl_count", "2.11", oracle(
    "SELECT run_id, COUNT(*) AS objects, COUNT(DISTINCT acl_fingerprint) AS unique_acls FROM oa GROUP BY run_id",
    "aces", lines=LINES, oa=OBJECT_ACL))
def q_unique_acl_count(spark, sf):
    return FP.unique_acl_count(fx.aces(spark, sf))


@register("top_acls_by_folders", "2.11", oracle("""
SELECT run_id, acl_fingerprint, acl_ace_count, COUNT(*) AS object_count
FROM oa GROUP BY run_id, acl_fingerprint, acl_ace_count
ORDER BY object_count DESC, acl_fingerprint ASC LIMIT 20""", "aces", lines=LINES, oa=OBJECT_ACL))
def q_top_acls_by_folders(spark, sf):
    return FP.top_acls_by_folders(fx.aces(spark, sf))


_LOCAL = Ruleset(tuple(FP.local_rules(DEFAULT)), DEFAULT.admin_identities, DEFAULT.version, DEFAULT.raw)


@register("rules_on_definitions", "2.11", oracle(
    "SELECT 'run-a' AS run_id, * FROM m", m=rules_oracle(_LOCAL)))
def q_rules_on_definitions(spark, sf):
    # must equal apply_rules restricted to the ACE-local rules (the oracle is
    # exactly that: the per-ACE rule SQL over the raw ACE table)
    return FP.rules_on_definitions(fx.aces(spark, sf), DEFAULT)


FINDINGS = f"""
SELECT m.run_id, m.rule_id, m.severity, o.object_id, m.folder_path, m.ace_name, m.ace_sid, m.ace_mask,
       m.ace_inherited, 'rule ' || m.rule_id || ' matched mask ' || m.ace_mask AS reason, o.source_file
FROM (SELECT 'run-a' AS run_id, * FROM m) m
LEFT JOIN (SELECT run_id, COALESCE(folder_path, '') AS folder_path, {_OBJID} AS object_id,
                  MIN(source_file) AS source_file
           FROM aces GROUP BY run_id, folder_path) o
  ON o.run_id = m.run_id AND o.folder_path = m.folder_path"""


@register("findings_standard", "2.11", oracle(FINDINGS, "aces", m=rules_oracle(DEFAULT)))
def q_findings_standard(spark, sf):
    aces = fx.aces(spark, sf)
    from permscope.operators.rules import apply_rules
    return FP.findings_standard(apply_rules(aces, DEFAULT, keep=("run_id",)), aces)


# --- canonical ACLs (v2): flags, protection, owner ---

def _flags_sql(words: str) -> str:
    w = f"lower({words})"
    return " || ".join(f"CASE WHEN contains({w}, '{n}') THEN '{c}' ELSE '' END"
                       for c, n in (("OI", "objectinherit"), ("CI", "containerinherit"), ("NP", "nopropagateinherit"), ("IO", "inheritonly")))


_RAW_FLAGS = ("COALESCE(CASE WHEN starts_with(ace_raw, '{') THEN " + _flags_sql(
    "concat_ws(', ', json_extract_string(ace_raw, '$.InheritanceFlags'), json_extract_string(ace_raw, '$.PropagationFlags'))") + " END, '')")
_OWNER = """CASE WHEN sddl LIKE 'O:BA%' THEN 'S-1-5-32-544' ELSE nullif(regexp_extract(sddl, '^O:(S-[0-9-]+)', 1), '') END"""
_PROTECTED = "regexp_extract(sddl, '^[^(]*D:([A-Z]*)[(]', 1) LIKE 'P%'"


def _canon_ctes(src: str) -> dict[str, str]:
    return {
        "cl0": f"""
SELECT run_id, folder_path, trim(COALESCE(ace_sid, '')) AS sid,
       CASE WHEN trim(COALESCE(ace_sid, '')) = '' THEN {S.res_name()} ELSE '' END AS name,
       lower(COALESCE(ace_type, '')) AS type, {_NMASK} AS mask, COALESCE(ace_inherited, false) AS inherited, {_RAW_FLAGS} AS flags,
       {_OWNER} AS own, {_PROTECTED} AS protected, collected_utc
FROM {src}""",
        "cl1": """
SELECT *, md5(concat_ws('|', CASE WHEN sid <> '' THEN sid ELSE 'name:' || name END, type, mask,
                        CASE WHEN inherited THEN '1' ELSE '0' END, flags)) AS h FROM cl0""",
        "cl2": "SELECT *, " + ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT AS h{i}" for i in range(4)) + " FROM cl1",
        "coa": f"""
SELECT run_id, {_OBJID} AS object_id, folder_path,
       sha256(concat_ws(':', n::VARCHAR, s0::VARCHAR, s1::VARCHAR, s2::VARCHAR, s3::VARCHAR)) AS acl_fingerprint,
       n AS acl_ace_count, is_protected, owner_sid, collected_at, 'acl-canon-v2' AS canonicalization_version
FROM (SELECT run_id, folder_path, COUNT(*) AS n, SUM(h0) AS s0, SUM(h1) AS s1, SUM(h2) AS s2, SUM(h3) AS s3,
             bool_or(protected) AS is_protected, MIN(own) AS owner_sid, MAX(collected_utc) AS collected_at
      FROM cl2 GROUP BY run_id, folder_path)""",
    }


_TWO = "(SELECT * FROM aces UNION ALL SELECT * FROM aces_b)"


@register("object_acl_canonical", "2.11", oracle("SELECT * FROM coa", "aces", "aces_b", **_canon_ctes(_TWO)))
def q_object_acl_canonical(spark, sf):
    return CA.object_acl(fx.aces_two_runs(spark, sf))


@register("acl_definitions_canonical", "2.11", oracle(f"""
SELECT acl_fingerprint, acl_ace_count, object_count, block, blocks, canonical_acl_json, 'acl-canon-v2' AS canonicalization_version
FROM (SELECT acl_fingerprint, acl_ace_count, COUNT(*) AS object_count FROM coa GROUP BY 1, 2)
JOIN (SELECT acl_fingerprint, floor(h0 * blocks / 4294967296)::INT AS block, blocks,
             to_json(list(struct_pack(sid := sid, name := name, type := type, mask := mask, inherited := inherited, flags := flags, n := n)
                          ORDER BY sid, name, type, mask, inherited, flags))::VARCHAR AS canonical_acl_json
      FROM (SELECT *, ceil(COUNT(*) OVER (PARTITION BY acl_fingerprint) / {CA.BLOCK})::INT AS blocks FROM (
              SELECT c.acl_fingerprint, sid, name, type, mask, inherited, flags, h0, COUNT(*) AS n
              FROM cl2 l JOIN (SELECT acl_fingerprint, min(struct_pack(r := run_id, f := COALESCE(folder_path, ''))) AS x FROM coa GROUP BY 1) c
                ON l.run_id = c.x.r AND COALESCE(l.folder_path, '') = c.x.f
              GROUP BY ALL)) GROUP BY ALL) USING (acl_fingerprint)""", "aces", "aces_b", **_canon_ctes(_TWO)))
def q_acl_definitions_canonical(spark, sf):
    return CA.acl_definitions(fx.aces_two_runs(spark, sf))


@register("sddl_entries", "2.11", oracle(f"""
SELECT d.sddl, {_OWNER} AS owner_sid, {_PROTECTED} AS is_protected, x.pos::INT AS pos, x.ace_type, x.ace_flags, x.ace_mask, x.ace_sid, x.inherited
FROM (SELECT DISTINCT sddl, regexp_extract(sddl, 'S-1-5-21-2-[0-9]+') AS grp FROM aces WHERE sddl IS NOT NULL) d,
LATERAL (VALUES
  (0, 'allow', CASE WHEN sddl LIKE 'O:BA%' THEN '' ELSE 'OICI' END, CASE WHEN sddl LIKE 'O:BA%' THEN 1179785 ELSE 2032127 END,
   CASE WHEN sddl LIKE 'O:BA%' THEN 'S-1-1-0' ELSE 'S-1-5-32-544' END, false),
  (1, 'deny', 'CIID', 1245631, grp, true), (2, 'allow', 'OIIO', 2684354560, 'S-1-5-11', false)
) x(pos, ace_type, ace_flags, ace_mask, ace_sid, inherited)
WHERE x.pos = 0 OR sddl NOT LIKE 'O:BA%'""", "aces"))
def q_sddl_entries(spark, sf):
    d = fx.aces(spark, sf).select("sddl").where("sddl is not null").distinct()
    return d.select("sddl", SD.sddl_owner(F.col("sddl")).alias("owner_sid"), SD.sddl_protected(F.col("sddl")).alias("is_protected"),
                    F.posexplode(SD.sddl_aces(F.col("sddl"))).alias("pos", "x")).select("sddl", "owner_sid", "is_protected", "pos", "x.*")
