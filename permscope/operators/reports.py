"""The SQL reports over the ACE table, as DataFrame plans.

Each report is ORDER BY ... LIMIT (a top-k report: the limit is the
feature).  Ties are broken on every output column and NULLs sort last, so
the k rows are deterministic.  ``orderBy(...).limit(k)`` plans as
``TakeOrderedAndProject``: each partition keeps its own top k and only
k x partitions rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import high_perm_sql
from permscope.operators.runs import run_keys


def _topk(df: DataFrame, order, k: int | None) -> DataFrame:
    df = df.orderBy(*order)
    return df.limit(k) if k else df


def top_identities_high_perms(aces: DataFrame, k: int | None = 200) -> DataFrame:
    """Distinct folders per ``ace_name`` over high-permission ACEs."""
    agg = (aces.filter(high_perm_sql("ace_mask"))
           .groupBy("ace_name")
           .agg(F.countDistinct("folder_path").alias("folders_with_high_perms")))
    return _topk(agg, [F.desc("folders_with_high_perms"), F.asc_nulls_last("ace_name")], k)


def ace_counts_by_appliance(aces: DataFrame, k: int | None = 200) -> DataFrame:
    """ACE rows per appliance; a null appliance is grouped as 'unknown'."""
    agg = (aces.groupBy(F.coalesce("appliance_hostname", F.lit("unknown")).alias("appliance_hostname"))
           .agg(F.count(F.lit(1)).alias("ace_count")))
    return _topk(agg, [F.desc("ace_count"), F.asc_nulls_last("appliance_hostname")], k)


def inherited_exposures(aces: DataFrame, k: int | None = 1000) -> DataFrame:
    """Inherited ACEs granting high permissions, by folder."""
    rows = (aces.filter(F.col("ace_inherited") & high_perm_sql("ace_mask"))
            .select("folder_path", "ace_name", "ace_mask", "ace_inherited"))
    return _topk(rows, [F.asc_nulls_last("folder_path"), F.asc_nulls_last("ace_name"),
                        F.asc_nulls_last("ace_mask")], k)


def fingerprint_variants(aces: DataFrame, k: int | None = 200) -> DataFrame:
    """Folders seen with more than one ACL fingerprint."""
    agg = (aces.groupBy("folder_path")
           .agg(F.countDistinct("fingerprint_sha256").alias("fingerprint_variants"))
           .filter(F.col("fingerprint_variants") > 1))
    return _topk(agg, [F.desc("fingerprint_variants"), F.asc_nulls_last("folder_path")], k)


def owners_without_admin_ace(aces: DataFrame, k: int | None = 200) -> DataFrame:
    """(folder, owner) pairs whose folder has no ACE with 'admin' in the name."""
    owners = aces.filter(F.col("owner").isNotNull()).select("folder_path", "owner").distinct()
    admin_folders = (aces.filter(F.lower(F.coalesce("ace_name", F.lit(""))).contains("admin"))
                     .select("folder_path").distinct())
    rows = owners.join(admin_folders, "folder_path", "left_anti")
    return _topk(rows, [F.asc_nulls_last("folder_path"), F.asc_nulls_last("owner")], k)


def distinct_folders(aces: DataFrame) -> DataFrame:
    return aces.select("folder_path").distinct()


def sid_set(aces: DataFrame) -> DataFrame:
    return aces.filter(F.col("ace_sid").isNotNull() & (F.col("ace_sid") != "")).select("ace_sid").distinct()


def folder_ace_counts(aces: DataFrame) -> DataFrame:
    """ACEs per run and folder (null folders grouped as '')."""
    return (aces.groupBy(*run_keys(aces), F.coalesce("folder_path", F.lit("")).alias("folder_path"))
            .agg(F.count(F.lit(1)).alias("ace_count")))


def duplicate_aces(aces: DataFrame) -> DataFrame:
    """(run, folder, resolved identity) groups holding more than one ACE."""
    from permscope.operators.rules import normalize_aces
    n = normalize_aces(aces)
    return (n.groupBy(*(F.col(f"run.{c}").alias(c) for c in run_keys(aces)), F.col("folder").alias("folder_path"), F.col("res_name").alias("ace_name"))
            .agg(F.count(F.lit(1)).alias("ace_count"))
            .filter(F.col("ace_count") > 1))
