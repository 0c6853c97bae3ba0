"""Catalogue: finders, presence checks and rankings."""

from __future__ import annotations

from permscope.functions.patterns import sql_any_hits, sql_hits, sql_quote
from permscope.functions.predicates import (ADMIN_PATTERNS_FULL, ADMIN_PATTERNS_SENSITIVE,
                                            BROAD_IDENTITIES, EVERYONE_PATTERNS, KEYWORD_GROUPS)
from permscope.operators import finders as FD
from permscope.operators import rules as RU
from permscope.plans import sqlparts as S
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx
from permscope.sources.ruleset import load_ruleset

DEFAULT = load_ruleset()
RES = S.res_name()
PSN = S.ps_name()
SID = "COALESCE(ace_sid, '')"
MASK = "COALESCE(ace_mask, '')"
INH = "COALESCE(ace_inherited, false)"

# a folder present at every scale factor (orders with l_orderkey % 16 = 0 of nation 0)
TARGET_FOLDER = "\\\\filer0.example.com\\bulk\\all"


def _keyword_case(col: str) -> tuple[str, str]:
    g, p = [], []
    for group, pats in KEYWORD_GROUPS:
        for pat in pats:
            cond = f"contains(lower({col}), {sql_quote(pat)})"
            g.append(f"WHEN {cond} THEN {sql_quote(group)}")
            p.append(f"WHEN {cond} THEN {sql_quote(pat)}")
    return "CASE " + " ".join(g) + " END", "CASE " + " ".join(p) + " END"


@register("everyone_full_control", "2.5", oracle(f"""
SELECT TRIM(folder_path) AS folder_path, res_name AS ace_name, ace_mask, ace_sid
FROM (SELECT *, {RES} AS res_name FROM aces WHERE {S.valid_folder()})
WHERE {S.contains_any('res_name', EVERYONE_PATTERNS)} AND {S.is_full()}""", "aces"))
def q_everyone_full_control(spark, sf):
    return FD.everyone_full_control(fx.aces(spark, sf))


_KG, _KP = _keyword_case("folder")


@register("sensitive_shares_broad_perms", "2.5", oracle(f"""
SELECT folder AS folder_path, {_KG} AS keyword_group, {_KP} AS matched_pattern,
       res_name AS ace_name, ace_mask, ace_sid, ace_inherited
FROM (SELECT *, TRIM(folder_path) AS folder, {RES} AS res_name FROM aces WHERE {S.valid_folder()})
WHERE ({_KG}) IS NOT NULL AND NOT {S.contains_any('res_name', ADMIN_PATTERNS_SENSITIVE)}
  AND {S.contains_any('res_name', BROAD_IDENTITIES)} AND {S.is_full()}""", "aces"))
def q_sensitive_shares(spark, sf):
    return FD.sensitive_shares_broad_perms(fx.aces(spark, sf))


@register("folders_missing_admin_full", "2.4", oracle(f"""
SELECT run_id, TRIM(folder_path) AS folder_path, COUNT(*) AS ace_count
FROM (SELECT *, {RES} AS res_name FROM aces WHERE {S.valid_folder()})
GROUP BY run_id, TRIM(folder_path)
HAVING NOT bool_or({S.contains_any('res_name', ADMIN_PATTERNS_FULL)} AND {S.is_full()})""", "aces"))
def q_folders_missing_admin_full(spark, sf):
    return FD.folders_missing_admin_full(fx.aces(spark, sf))


def _missing_sql(pats, perm, rule_id, include_inherited=False, src="aces") -> str:
    hit = f"({sql_any_hits(PSN, pats)} OR {sql_any_hits(SID, pats)})"
    perm_sql = f"({sql_hits(MASK, perm)} AND {MASK} <> '')" if perm is not None else S.high_bitmask(MASK)
    inh = "true" if include_inherited else f"NOT {INH}"
    return f"""
SELECT source_file, folder_path, {sql_quote(rule_id)} AS missing_rule,
       {sql_quote(','.join(p.text for p in pats))} AS expected_identities, '' AS found_identities
FROM {src} GROUP BY source_file, folder_path
HAVING NOT COALESCE(bool_or({inh} AND {hit} AND {perm_sql}), false)"""


_AM = DEFAULT.rule("AdminsMissing")


@register("missing_admins", "2.4", oracle(_missing_sql(DEFAULT.admin_identities, _AM.perm_match, _AM.id), "aces"))
def q_missing_admins(spark, sf):
    return FD.missing_admins(fx.aces(spark, sf), DEFAULT)


def _missing_both() -> str:
    args = (DEFAULT.admin_identities, _AM.perm_match, _AM.id)
    return _missing_sql(*args) + "\nUNION ALL\n" + _missing_sql(*args, src="aces_b")


@register("missing_admins_two_runs", "2.4", oracle(_missing_both(), "aces", "aces_b"))
def q_missing_admins_two_runs(spark, sf):
    return FD.missing_admins(fx.aces(spark, sf, "a").unionByName(fx.aces(spark, sf, "b")), DEFAULT)


_REQ = ("Domain Admins",)


@register("missing_required_groups", "2.4", oracle(
    _missing_sql(tuple(FD._like(g) for g in _REQ), None, "RequiredGroups"), "aces"))
def q_missing_required_groups(spark, sf):
    return FD.missing_required_groups(fx.aces(spark, sf), _REQ)


def _accessible_sql(pats, include_inherited=False) -> str:
    hit = f"({sql_any_hits(PSN, pats)} OR {sql_any_hits(SID, pats)})"
    inh = "" if include_inherited else f" AND NOT {INH}"
    return f"""
SELECT source_file, folder_path, {PSN} AS ace_name, {SID} AS ace_sid, {INH} AS ace_inherited, ace_raw
FROM aces WHERE {hit}{inh}"""


@register("accessible_by", "2.5", oracle(_accessible_sql((FD._like("Domain Users"),)), "aces"))
def q_accessible_by(spark, sf):
    return FD.accessible_by(fx.aces(spark, sf), "Domain Users", DEFAULT)


@register("accessible_by_rule", "2.5", oracle(
    _accessible_sql(DEFAULT.rule("AuthUsersBroadPerms").identity_patterns, include_inherited=True), "aces"))
def q_accessible_by_rule(spark, sf):
    return FD.accessible_by(fx.aces(spark, sf), "authusersbroadperms", DEFAULT, include_inherited=True)


def broad_sql(rs=DEFAULT, targets=None, include_inherited=False) -> str:
    high = S.high_bitmask(MASK)
    cases = []
    if targets is not None:
        pats = [FD._like(t) for t in targets]
        cases.append(f"CASE WHEN ({sql_any_hits(PSN, pats)} OR {sql_any_hits(SID, pats)}) AND {high} "
                     f"THEN 'fallback' END")
    else:
        for r in rs.rules:
            pats = rs.admin_identities if (r.match_admin_identities and rs.admin_identities) else r.identity_patterns
            if not pats:
                continue
            cond = f"({sql_any_hits(PSN, pats)} OR {sql_any_hits(SID, pats)}) AND {high}"
            if r.perm_match is not None:
                cond += f" AND {sql_hits(MASK, r.perm_match)}"
            cases.append(f"CASE WHEN {cond} THEN {sql_quote(r.id)} END")
    arr = f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"
    inh = "" if include_inherited else f"AND NOT {INH}"
    return f"""
SELECT source_file, folder_path, ace_name, ace_sid, ace_mask, ace_inherited,
       array_to_string(m, ',') AS matched_rules, ace_raw
FROM (SELECT source_file, folder_path, {PSN} AS ace_name, {SID} AS ace_sid, {MASK} AS ace_mask,
             {INH} AS ace_inherited, {arr} AS m, ace_raw FROM aces)
WHERE len(m) > 0 {inh}"""


@register("broad_perms", "2.5", oracle(broad_sql(), "aces"))
def q_broad_perms(spark, sf):
    return FD.broad_perms(fx.aces(spark, sf), DEFAULT)


@register("broad_perms_targets", "2.5", oracle(broad_sql(targets=FD.DEFAULT_TARGETS), "aces"))
def q_broad_perms_targets(spark, sf):
    return FD.broad_perms_targets(fx.aces(spark, sf))


@register("filter_matches_by_rule", "2.4", oracle(
    "SELECT * FROM bp WHERE list_contains(list_transform(string_split(matched_rules, ','), lambda x: trim(x)), "
    "'EveryoneModify')", "aces", bp=broad_sql()))
def q_filter_matches_by_rule(spark, sf):
    return RU.filter_matches_by_rule(FD.broad_perms(fx.aces(spark, sf), DEFAULT), "EveryoneModify")


_WIDE = ("COALESCE(NULLIF(TRIM(ace_name), ''), CASE WHEN ace_raw IS NULL OR ace_raw = '' THEN '' ELSE "
         "TRIM(COALESCE(NULLIF(json_extract_string(ace_raw, '$.name'), ''), "
         "NULLIF(json_extract_string(ace_raw, '$.identity'), ''), ace_raw)) END)")
_RANK_BASE = (f"SELECT {_WIDE} AS identity, TRIM(COALESCE(folder_path, '')) AS folder, "
              f"list_filter(list_transform(string_split(TRIM(COALESCE(matched_rules, '')), ','), lambda x: trim(x)), "
              f"lambda x: x <> '') AS rules FROM bp")


@register("identity_ranking", "2.5", oracle("""
SELECT identity, COUNT(DISTINCT CASE WHEN identity <> '' THEN folder END) AS folder_count,
       COUNT(*) AS occurrences,
       array_to_string(list_sort(list_distinct(flatten(list(rules)))), ',') AS matched_rules
FROM rb GROUP BY identity
ORDER BY folder_count DESC, occurrences DESC, lower(identity), identity
LIMIT 20""", "aces", bp=broad_sql(), rb=_RANK_BASE))
def q_identity_ranking(spark, sf):
    return FD.identity_ranking(FD.broad_perms(fx.aces(spark, sf), DEFAULT))


@register("folders_multi_identity", "2.5", oracle("""
SELECT folder AS folder_path, COUNT(DISTINCT identity) AS identity_count
FROM rb WHERE folder <> '' GROUP BY folder HAVING COUNT(DISTINCT identity) > 1
ORDER BY identity_count DESC, folder_path
LIMIT 100""", "aces", bp=broad_sql(), rb=_RANK_BASE))
def q_folders_multi_identity(spark, sf):
    return FD.folders_multi_identity(FD.broad_perms(fx.aces(spark, sf), DEFAULT))


_RAW_OR_NAME = ("CASE WHEN ace_raw IS NULL OR ace_raw = '' THEN '' ELSE COALESCE("
                + ", ".join(f"NULLIF(json_extract_string(ace_raw, '$.\"{k}\"'), '')"
                            for k in ("name", "displayName", "displayname", "identity", "account",
                                      "accountName", "accountname", "sid"))
                + ", ace_raw) END")


@register("root_name_counts", "2.5", oracle(f"""
SELECT name, COUNT(*) AS hits FROM (
  SELECT ace_name AS name FROM aces WHERE ace_name IS NOT NULL AND contains(lower(ace_name), 'root')
  UNION ALL
  SELECT {_RAW_OR_NAME} AS name FROM aces WHERE ace_raw IS NOT NULL AND contains(lower(ace_raw), 'root')
) GROUP BY name""", "aces"))
def q_root_name_counts(spark, sf):
    return FD.root_name_counts(fx.aces(spark, sf))


@register("missing_folder_rows", "2.3", oracle(f"""
SELECT source_file, folder_path, unc_path, ace_name, ace_sid, ace_mask, ace_raw
FROM aces WHERE NOT {S.valid_folder()}""", "aces"))
def q_missing_folder_rows(spark, sf):
    return FD.missing_folder_rows(fx.aces(spark, sf))


@register("aces_for_folder", "2.3", oracle(f"""
SELECT folder_path, ace_name, ace_sid, ace_mask, ace_inherited, ace_type, ace_raw
FROM aces WHERE TRIM(folder_path) = {sql_quote(TARGET_FOLDER)}""", "aces"))
def q_aces_for_folder(spark, sf):
    return FD.aces_for_folder(fx.aces(spark, sf), TARGET_FOLDER)


@register("run_summary", "2.5", oracle("""
SELECT run_id, COUNT(DISTINCT source_file) AS files, COUNT(*) AS ace_rows,
       COUNT(DISTINCT folder_path) AS folders, COUNT(DISTINCT NULLIF(ace_sid, '')) AS distinct_sids
FROM (SELECT * FROM aces UNION ALL SELECT * FROM aces_b) GROUP BY run_id""", "aces", "aces_b"))
def q_run_summary(spark, sf):
    return FD.run_summary(fx.aces_two_runs(spark, sf))





@register("runtime_filters", "2.3", oracle(f"""
SELECT * FROM aces
WHERE ({sql_any_hits(PSN, [FD._like('svc')])} OR {sql_any_hits(SID, [FD._like('svc')])})
  AND {S.mask_int('ace_mask')} >= 2 AND NOT COALESCE(ace_inherited, false)
  AND lower(share_name) = 'bulk'""", "aces"))
def q_runtime_filters(spark, sf):
    return FD.runtime_filters(fx.aces(spark, sf), identities=["svc"], min_mask=2, inherited=False, share="bulk")


@register("runtime_filters_ci", "2.3", oracle(f"""
SELECT * FROM aces
WHERE ({sql_any_hits(PSN, [FD._like('svc')])} OR {sql_any_hits(SID, [FD._like('svc')])})
  AND COALESCE(ace_inherited, false) AND lower(appliance_hostname) = 'filer3.example.com'""", "aces"))
def q_runtime_filters_ci(spark, sf):
    return FD.runtime_filters(fx.aces(spark, sf), identities=["svc"], inherited=True,
                              appliance="FILER3.example.com", ignore_case=True)


@register("baseline_row_counts", "2.5", oracle("""
SELECT 'ace_rows_per_appliance' AS kind, COALESCE(appliance_hostname, 'unknown') AS key, COUNT(*) AS n
FROM aces GROUP BY 2
UNION ALL
SELECT 'ace_rows_per_volume', COALESCE(volume_name, 'unknown'), COUNT(*) FROM aces GROUP BY 2
UNION ALL
SELECT 'folders_per_share', COALESCE(appliance_hostname, 'unknown') || chr(92) || COALESCE(share_name, 'unknown'),
       COUNT(DISTINCT folder_path) FROM aces GROUP BY 2
UNION ALL
(SELECT 'aces_of_top_principal', COALESCE(NULLIF(trim(ace_name), ''), NULLIF(ace_sid, ''), 'unknown') AS key, COUNT(*) AS n
 FROM aces GROUP BY 2 ORDER BY n DESC, key LIMIT 20)
UNION ALL
SELECT 'ace_rows_without_folder', 'all', COUNT(*) FILTER (WHERE NOT ({valid})) FROM aces""".format(valid=S.valid_folder()), "aces"))
def q_baseline_row_counts(spark, sf):
    return FD.baseline_row_counts(fx.aces(spark, sf))
