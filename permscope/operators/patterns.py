"""Vulnerability-pattern reports over one snapshot.

Each pattern is a filter or an aggregation of the ACE table; the drift
patterns (new broad ACEs, mass permission change) are in ``drift``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import high_perm_bitmask, is_full_control, rights_bucket
from permscope.functions.names import resolve_name
from permscope.functions.paths import ancestors, path_depth, valid_folder
from permscope.functions.patterns import contains_any
from permscope.functions.predicates import (ADMIN_PATTERNS_FULL, ADMIN_PATTERNS_SENSITIVE, BACKUP_WORDS,
                                            GENERIC_LARGE_GROUPS, KEYWORD_GROUPS, SCRIPT_WORDS,
                                            SERVICE_ACCOUNT_WORDS, is_admin_name, is_broad_identity,
                                            match_keyword_group)
from permscope.operators.runs import run_keys

# The sensitive keyword groups of the pattern catalogue add an
# Audit group to the finder's groups.
PATTERN_KEYWORD_GROUPS = KEYWORD_GROUPS + (("Audit", ("audit", "auditoria", "auditoría")),)

# Identities of the "Everyone / Authenticated" pattern.
EVERYONE_OR_AUTH = ("everyone", "s-1-1-0", "authenticated users", "s-1-5-11")


def _named(aces: DataFrame) -> DataFrame:
    return aces.withColumn("res_name", resolve_name("ace_name", "ace_raw"))


def _rows(df: DataFrame) -> DataFrame:
    return df.select("folder_path", F.col("res_name").alias("ace_name"), "ace_sid", "ace_mask", "ace_inherited")


def everyone_or_authenticated_full(aces: DataFrame) -> DataFrame:
    a = _named(aces)
    return _rows(a.filter(contains_any("res_name", EVERYONE_OR_AUTH) & is_full_control("ace_mask")))


def non_admin_group_full(aces: DataFrame) -> DataFrame:
    a = _named(aces)
    return _rows(a.filter(contains_any("res_name", GENERIC_LARGE_GROUPS)
                          & ~is_admin_name("res_name", ADMIN_PATTERNS_FULL) & is_full_control("ace_mask")))


def orphaned_sid_report(aces: DataFrame) -> DataFrame:
    """SIDs whose name is empty or itself a raw SID, with folder and ACE counts."""
    a = _named(aces).filter(F.coalesce(F.col("ace_sid"), F.lit("")) != "")
    orphan = (F.col("res_name") == "") | F.col("res_name").rlike("^S-1-")
    return (a.filter(orphan).groupBy("ace_sid")
            .agg(F.countDistinct("folder_path").alias("folders"), F.count(F.lit(1)).alias("aces")))


def service_account_broad(aces: DataFrame) -> DataFrame:
    a = _named(aces)
    return _rows(a.filter(contains_any("res_name", SERVICE_ACCOUNT_WORDS) & high_perm_bitmask("ace_mask")))


def broad_inherited_by_ancestor(aces: DataFrame, min_folders: int = 2) -> DataFrame:
    """Ancestor paths under which one broad identity holds inherited high
    permissions on at least ``min_folders`` folders."""
    a = _named(aces).filter(F.coalesce("ace_inherited", F.lit(False)) & is_broad_identity("res_name")
                            & high_perm_bitmask("ace_mask") & valid_folder("folder_path"))
    # pre-aggregate to one row per (folder, identity) before exploding the
    # ancestors: the explode then grows with folders, not with ACEs, and each
    # (ancestor, identity, folder) appears once, so a plain count is exact
    runs = run_keys(aces)
    per_folder = a.groupBy(*runs, "folder_path", F.col("res_name").alias("identity")).agg(F.count(F.lit(1)).alias("n"))
    x = per_folder.select(*runs, "identity", "n", F.explode(ancestors("folder_path")).alias("ancestor"))
    return (x.groupBy(*runs, "ancestor", "identity")
            .agg(F.count(F.lit(1)).alias("folders"), F.sum("n").alias("aces"))
            .filter(F.col("folders") >= min_folders))


def excessive_ace_count(aces: DataFrame, threshold: int = 100) -> DataFrame:
    runs = run_keys(aces)
    return (aces.groupBy(*runs, "folder_path").agg(F.count(F.lit(1)).alias("ace_count"))
            .filter(F.col("ace_count") > threshold))


def sensitive_keywords_exposed(aces: DataFrame) -> DataFrame:
    """Sensitive keyword folders (with Audit) where a broad, non-admin identity
    holds high permissions (any high right, not only FullControl)."""
    a = _named(aces).filter(valid_folder("folder_path") & is_broad_identity("res_name")
                            & high_perm_bitmask("ace_mask") & ~is_admin_name("res_name", ADMIN_PATTERNS_SENSITIVE))
    a = a.select("*", F.explode(F.array(match_keyword_group("folder_path", PATTERN_KEYWORD_GROUPS))).alias("kw"))
    return a.filter(F.col("kw").isNotNull()).select("folder_path", F.col("kw.keyword_group").alias("keyword_group"),
                                F.col("res_name").alias("ace_name"), "ace_sid", "ace_mask")


def share_root_missing_admin(aces: DataFrame) -> DataFrame:
    """Share roots (path depth host+share) with no admin FullControl ACE."""
    a = _named(aces).filter(valid_folder("folder_path") & (path_depth("folder_path") == 2))
    admin_full = is_admin_name("res_name", ADMIN_PATTERNS_FULL) & is_full_control("ace_mask")
    g = a.groupBy(*run_keys(aces), "folder_path").agg(F.bool_or(admin_full).alias("ok"), F.count(F.lit(1)).alias("ace_count"))
    return g.filter(~F.col("ok")).select(*run_keys(aces), "folder_path", "ace_count")


def _path_broad_write(aces: DataFrame, words) -> DataFrame:
    a = _named(aces)
    return _rows(a.filter(contains_any("folder_path", words) & is_broad_identity("res_name")
                          & rights_bucket("ace_mask").isin("write", "fullcontrol")))


def backup_share_broad_write(aces: DataFrame) -> DataFrame:
    return _path_broad_write(aces, BACKUP_WORDS)


def script_folder_broad_write(aces: DataFrame) -> DataFrame:
    return _path_broad_write(aces, SCRIPT_WORDS)


def remediation_backlog(aces: DataFrame) -> DataFrame:
    """One row per exposed folder: sensitive category, Everyone / Domain Users
    present, inherited exposure, ACE count and a priority score."""
    a = _named(aces).filter(valid_folder("folder_path"))
    everyone = contains_any("res_name", ("everyone", "s-1-1-0"))
    domain_users = contains_any("res_name", ("domain users",))
    broad_high = is_broad_identity("res_name") & high_perm_bitmask("ace_mask")
    g = a.groupBy(*run_keys(aces), "folder_path").agg(
        F.bool_or(everyone).alias("everyone_present"),
        F.bool_or(domain_users).alias("domain_users_present"),
        F.bool_or(broad_high & F.coalesce("ace_inherited", F.lit(False))).alias("inherited_exposure"),
        F.bool_or(broad_high).alias("broad_high"),
        F.count(F.lit(1)).alias("ace_count"))
    g = g.filter(F.col("broad_high")).drop("broad_high")
    # the category depends on the path only: computed once per folder
    g = g.withColumn("sensitive_category", match_keyword_group("folder_path").getField("keyword_group"))
    prio = (F.when(F.col("sensitive_category").isNotNull(), 8).otherwise(0)
            + F.when(F.col("everyone_present"), 4).otherwise(0)
            + F.when(F.col("domain_users_present"), 2).otherwise(0)
            + F.when(F.col("inherited_exposure"), 1).otherwise(0))
    return g.withColumn("priority", prio)
