"""Run-to-run drift: findings, ACL changes, membership changes, new grants.

Every comparison is a join of two snapshots on a stable key
(anti / semi / full-outer); nothing is collected.  Keys: a finding is
(rule_id, folder_path, ace_name, ace_sid, ace_mask, ace_inherited); an
identity on an ACE is its SID, else its resolved name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import bucket_rank, high_perm_bitmask, rights_bucket
from permscope.functions.names import resolve_name
from permscope.functions.predicates import is_broad_identity
from permscope.operators.fingerprint import object_acl
from permscope.operators.rules import severity_rank_col

FINDING_KEY = ["rule_id", "folder_path", "ace_name", "ace_sid", "ace_mask", "ace_inherited"]


def _keys(m: DataFrame) -> DataFrame:
    """Distinct findings, grouped on exactly the join key (severity follows
    from the rule), so the anti / semi join reuses this aggregation's
    partitioning instead of shuffling the findings a second time."""
    if "severity" in m.columns:
        return m.groupBy(*FINDING_KEY).agg(F.max("severity").alias("severity"))
    return m.groupBy(*FINDING_KEY).agg()


def findings_added(before: DataFrame, after: DataFrame) -> DataFrame:
    """Findings present in ``after`` and not in ``before``."""
    return _keys(after).join(_keys(before).select(FINDING_KEY), FINDING_KEY, "left_anti")


def findings_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    return _keys(before).join(_keys(after).select(FINDING_KEY), FINDING_KEY, "left_anti")


def findings_persisting(before: DataFrame, after: DataFrame) -> DataFrame:
    return _keys(after).join(_keys(before).select(FINDING_KEY), FINDING_KEY, "left_semi")


def new_high_severity_findings(before: DataFrame, after: DataFrame) -> DataFrame:
    return findings_added(before, after).filter(F.lower("severity") == "high")


def acl_changed_objects(aces_before: DataFrame, aces_after: DataFrame) -> DataFrame:
    """Objects whose ACL fingerprint changed, plus new and removed objects."""
    a = object_acl(aces_before).select("object_id", F.col("folder_path").alias("fp_a"),
                                       F.col("acl_fingerprint").alias("old_fingerprint"))
    b = object_acl(aces_after).select("object_id", F.col("folder_path").alias("fp_b"),
                                      F.col("acl_fingerprint").alias("new_fingerprint"))
    j = a.join(b, "object_id", "full_outer")
    change = (F.when(F.col("old_fingerprint").isNull(), F.lit("added"))
              .when(F.col("new_fingerprint").isNull(), F.lit("removed"))
              .otherwise(F.lit("changed")))
    return (j.filter(~F.col("old_fingerprint").eqNullSafe(F.col("new_fingerprint")))
            .select("object_id", F.coalesce("fp_b", "fp_a").alias("folder_path"),
                    "old_fingerprint", "new_fingerprint", change.alias("change")))


def run_diff(aces_before: DataFrame, aces_after: DataFrame) -> DataFrame:
    """Summary of object-level changes: change -> objects."""
    return acl_changed_objects(aces_before, aces_after).groupBy("change").agg(F.count(F.lit(1)).alias("objects"))


def membership_diff(edges_before: DataFrame, edges_after: DataFrame) -> DataFrame:
    """Membership edges added / removed between two identity snapshots."""
    k = ["member_sid", "group_sid"]
    a = edges_before.select(*k).distinct()
    b = edges_after.select(*k).distinct()
    added = b.join(a, k, "left_anti").withColumn("change", F.lit("added"))
    removed = a.join(b, k, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def _broad(aces: DataFrame) -> DataFrame:
    name = resolve_name("ace_name", "ace_raw")
    return (aces.withColumn("res_name", name)
            .filter(is_broad_identity("res_name") & high_perm_bitmask("ace_mask"))
            .select(F.coalesce("folder_path", F.lit("")).alias("folder_path"),
                    F.coalesce(F.nullif("ace_sid", F.lit("")), F.col("res_name")).alias("identity"),
                    "res_name", "ace_mask", rights_bucket("ace_mask").alias("rights_bucket")))


def new_broad_aces(aces_before: DataFrame, aces_after: DataFrame) -> DataFrame:
    """Broad, high-permission ACEs in ``after`` whose (folder, identity) had none in ``before``."""
    b = _broad(aces_after)
    a = _broad(aces_before).select("folder_path", "identity").distinct()
    return (b.join(a, ["folder_path", "identity"], "left_anti")
            .select("folder_path", "identity", F.col("res_name").alias("ace_name"), "ace_mask").distinct())


def new_broad_write_grants(aces_before: DataFrame, aces_after: DataFrame) -> DataFrame:
    """Broad identities whose write-or-higher bucket on a folder is new (or rose)."""
    def best(df):
        return (_broad(df).groupBy("folder_path", "identity")
                .agg(F.max(bucket_rank("rights_bucket")).alias("rank")))
    a = best(aces_before).withColumnRenamed("rank", "rank_before")
    b = best(aces_after).withColumnRenamed("rank", "rank_after").filter(F.col("rank_after") >= 2)
    j = b.join(a, ["folder_path", "identity"], "left")
    return (j.filter(F.col("rank_after") > F.coalesce("rank_before", F.lit(0)))
            .select("folder_path", "identity", F.coalesce("rank_before", F.lit(0)).alias("rank_before"),
                    "rank_after"))


def mass_permission_change(aces_before: DataFrame, aces_after: DataFrame, threshold: int = 10) -> DataFrame:
    """Identities that gained or lost broad ACEs on at least ``threshold`` folders."""
    a = _broad(aces_before).select("folder_path", "identity").distinct()
    b = _broad(aces_after).select("folder_path", "identity").distinct()
    gained = b.join(a, ["folder_path", "identity"], "left_anti").withColumn("g", F.lit(1)).withColumn("l", F.lit(0))
    lost = a.join(b, ["folder_path", "identity"], "left_anti").withColumn("g", F.lit(0)).withColumn("l", F.lit(1))
    agg = (gained.unionByName(lost).groupBy("identity")
           .agg(F.sum("g").alias("folders_gained"), F.sum("l").alias("folders_lost")))
    return agg.filter(F.col("folders_gained") + F.col("folders_lost") >= threshold)


def risk_increased(matches_before: DataFrame, matches_after: DataFrame) -> DataFrame:
    """Folders whose highest finding severity rose between the runs."""
    def top(m):
        return m.groupBy("folder_path").agg(F.max(severity_rank_col()).alias("rank"),
                                            F.count(F.lit(1)).alias("findings"))
    a = top(matches_before).withColumnRenamed("rank", "rank_before").withColumnRenamed("findings", "findings_before")
    b = top(matches_after).withColumnRenamed("rank", "rank_after").withColumnRenamed("findings", "findings_after")
    j = b.join(a, "folder_path", "left")
    return (j.filter(F.col("rank_after") > F.coalesce("rank_before", F.lit(0)))
            .select("folder_path", F.coalesce("rank_before", F.lit(0)).alias("rank_before"), "rank_after",
                    F.coalesce("findings_before", F.lit(0)).alias("findings_before"), "findings_after"))


def skip_unchanged(aces_before: DataFrame, aces_after: DataFrame, ruleset_changed: bool = False) -> DataFrame:
    """ACE rows of ``after`` whose object is new or changed; all rows when the
    ruleset changed.  Feed the result to ``apply_rules`` to re-score only
    what moved."""
    if ruleset_changed:
        return aces_after
    a = object_acl(aces_before).select("object_id", "acl_fingerprint")
    b = object_acl(aces_after).select("object_id", "folder_path", "acl_fingerprint")
    moved = b.join(a, ["object_id", "acl_fingerprint"], "left_anti").select(F.col("folder_path").alias("_f"))
    return aces_after.join(moved, aces_after["folder_path"].eqNullSafe(moved["_f"]), "left_semi")
