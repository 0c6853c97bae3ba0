"""Catalogue: vulnerability-pattern reports."""

from __future__ import annotations

from permscope.functions.patterns import sql_quote
from permscope.functions.predicates import (ADMIN_PATTERNS_FULL, ADMIN_PATTERNS_SENSITIVE, BACKUP_WORDS,
                                            BROAD_IDENTITIES, GENERIC_LARGE_GROUPS, KEYWORD_GROUPS, SCRIPT_WORDS,
                                            SERVICE_ACCOUNT_WORDS)
from permscope.operators import patterns as PT
from permscope.plans import sqlparts as S
from permscope.plans.q_identity import _RANK
from permscope.plans.registry import oracle, register
from permscope.sources import fixtures as fx

NAMED = f"SELECT *, {S.res_name()} AS res_name FROM aces"
ROWS = "SELECT folder_path, res_name AS ace_name, ace_sid, ace_mask, ace_inherited FROM named WHERE "
HB = S.high_bitmask("ace_mask")


def _kw_case(groups, col="folder_path", field="group") -> str:
    parts = []
    for g, pats in groups:
        for p in pats:
            parts.append(f"WHEN contains(lower(COALESCE({col}, '')), {sql_quote(p)}) "
                         f"THEN {sql_quote(g if field == 'group' else p)}")
    return "CASE " + " ".join(parts) + " END"


@register("everyone_or_authenticated_full", "2.11", oracle(
    ROWS + f"{S.contains_any('res_name', PT.EVERYONE_OR_AUTH)} AND {S.is_full()}", "aces", named=NAMED))
def q_everyone_or_authenticated_full(spark, sf):
    return PT.everyone_or_authenticated_full(fx.aces(spark, sf))


@register("non_admin_group_full", "2.11", oracle(
    ROWS + f"{S.contains_any('res_name', GENERIC_LARGE_GROUPS)} AND NOT "
    f"{S.contains_any('res_name', ADMIN_PATTERNS_FULL)} AND {S.is_full()}", "aces", named=NAMED))
def q_non_admin_group_full(spark, sf):
    return PT.non_admin_group_full(fx.aces(spark, sf))


@register("orphaned_sid_report", "2.11", oracle("""
SELECT ace_sid, COUNT(DISTINCT folder_path) AS folders, COUNT(*) AS aces FROM named
WHERE COALESCE(ace_sid, '') <> '' AND (res_name = '' OR regexp_matches(res_name, '^S-1-'))
GROUP BY ace_sid""", "aces", named=NAMED))
def q_orphaned_sid_report(spark, sf):
    return PT.orphaned_sid_report(fx.aces(spark, sf))


@register("service_account_broad", "2.11", oracle(
    ROWS + f"{S.contains_any('res_name', SERVICE_ACCOUNT_WORDS)} AND {HB}", "aces", named=NAMED))
def q_service_account_broad(spark, sf):
    return PT.service_account_broad(fx.aces(spark, sf))


@register("broad_inherited_by_ancestor", "2.11", oracle(f"""
SELECT run_id, ancestor, identity, COUNT(DISTINCT folder_path) AS folders, COUNT(*) AS aces FROM (
  SELECT run_id, folder_path, res_name AS identity,
         chr(92) || chr(92) || array_to_string(segs[1:d], chr(92)) AS ancestor
  FROM (SELECT run_id, folder_path, res_name,
               list_filter(regexp_split_to_array(folder_path, '[/\\\\]'), lambda x: x <> '') AS segs
        FROM named
        WHERE COALESCE(ace_inherited, false) AND {S.contains_any('res_name', BROAD_IDENTITIES)}
          AND {HB} AND {S.valid_folder()}) t,
       range(2, len(segs)) r(d))
GROUP BY run_id, ancestor, identity HAVING COUNT(DISTINCT folder_path) >= 2""", "aces", named=NAMED))
def q_broad_inherited_by_ancestor(spark, sf):
    return PT.broad_inherited_by_ancestor(fx.aces(spark, sf))


@register("excessive_ace_count", "2.11", oracle(
    "SELECT run_id, folder_path, COUNT(*) AS ace_count FROM aces GROUP BY run_id, folder_path HAVING COUNT(*) > 100", "aces"))
def q_excessive_ace_count(spark, sf):
    return PT.excessive_ace_count(fx.aces(spark, sf))


@register("sensitive_keywords_exposed", "2.11", oracle(f"""
SELECT folder_path, {_kw_case(PT.PATTERN_KEYWORD_GROUPS)} AS keyword_group, res_name AS ace_name, ace_sid, ace_mask
FROM named WHERE {S.valid_folder()} AND ({_kw_case(PT.PATTERN_KEYWORD_GROUPS)}) IS NOT NULL
  AND NOT {S.contains_any('res_name', ADMIN_PATTERNS_SENSITIVE)}
  AND {S.contains_any('res_name', BROAD_IDENTITIES)} AND {HB}""", "aces", named=NAMED))
def q_sensitive_keywords_exposed(spark, sf):
    return PT.sensitive_keywords_exposed(fx.aces(spark, sf))


@register("share_root_missing_admin", "2.11", oracle(f"""
SELECT run_id, folder_path, COUNT(*) AS ace_count FROM named
WHERE {S.valid_folder()}
  AND len(list_filter(regexp_split_to_array(folder_path, '[/\\\\]'), lambda x: x <> '')) = 2
GROUP BY run_id, folder_path
HAVING NOT bool_or({S.contains_any('res_name', ADMIN_PATTERNS_FULL)} AND {S.is_full()})""", "aces", named=NAMED))
def q_share_root_missing_admin(spark, sf):
    return PT.share_root_missing_admin(fx.aces(spark, sf))


def _path_write_sql(words) -> str:
    return ROWS + (f"{S.contains_any('folder_path', words)} AND {S.contains_any('res_name', BROAD_IDENTITIES)} "
                   f"AND {_RANK} >= 2")


@register("backup_share_broad_write", "2.11", oracle(_path_write_sql(BACKUP_WORDS), "aces", named=NAMED))
def q_backup_share_broad_write(spark, sf):
    return PT.backup_share_broad_write(fx.aces(spark, sf))


@register("script_folder_broad_write", "2.11", oracle(_path_write_sql(SCRIPT_WORDS), "aces", named=NAMED))
def q_script_folder_broad_write(spark, sf):
    return PT.script_folder_broad_write(fx.aces(spark, sf))


@register("remediation_backlog", "2.11", oracle(f"""
SELECT *, (CASE WHEN sensitive_category IS NOT NULL THEN 8 ELSE 0 END
         + CASE WHEN everyone_present THEN 4 ELSE 0 END
         + CASE WHEN domain_users_present THEN 2 ELSE 0 END
         + CASE WHEN inherited_exposure THEN 1 ELSE 0 END) AS priority
FROM (
  SELECT run_id, folder_path,
         bool_or({S.contains_any('res_name', ('everyone', 's-1-1-0'))}) AS everyone_present,
         bool_or({S.contains_any('res_name', ('domain users',))}) AS domain_users_present,
         bool_or({S.contains_any('res_name', BROAD_IDENTITIES)} AND {HB} AND COALESCE(ace_inherited, false))
           AS inherited_exposure,
         COUNT(*) AS ace_count,
         {_kw_case(KEYWORD_GROUPS)} AS sensitive_category
  FROM named WHERE {S.valid_folder()}
  GROUP BY run_id, folder_path
  HAVING bool_or({S.contains_any('res_name', BROAD_IDENTITIES)} AND {HB}))""", "aces", named=NAMED))
def q_remediation_backlog(spark, sf):
    return PT.remediation_backlog(fx.aces(spark, sf))
