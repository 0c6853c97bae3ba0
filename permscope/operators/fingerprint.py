"""Objects, ACL fingerprints and fingerprint-level rule scoring.

Canonical ACE line (``acl-canon-v1``)::

    sid | resolved name | lower(type) | normalized mask | inherited

An ACL's fingerprint must not depend on ACE order or on the folder path.
Collecting a folder's lines into one sorted list would put a whole folder
into one task (a single folder may hold a large share of all rows), so the
fingerprint is a *multiset hash* built by partial aggregation instead:
each line's md5 is cut into four 32-bit slices, the slices are summed
exactly (BIGINT, no overflow below 2^31 ACEs per folder), and
``sha2('count:s1:s2:s3:s4', 256)`` is the fingerprint.  Same multiset of
lines -> same fingerprint, on any partitioning; the same text formula runs
in DuckDB, so the oracle reproduces it bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import normalize_mask
from permscope.functions.names import resolve_name
from permscope.functions.paths import path_depth
from permscope.operators.metrics import unc_filer_share

CANONICALIZATION_VERSION = "acl-canon-v1"


def _col(df: DataFrame, name: str, typ: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def ace_lines(aces: DataFrame) -> DataFrame:
    """ACE rows with their canonical line and the md5 slices of it."""
    res = resolve_name(_col(aces, "ace_name"), _col(aces, "ace_raw"))
    line = F.concat_ws(
        "|",
        F.coalesce(_col(aces, "ace_sid"), F.lit("")),
        res,
        F.lower(F.coalesce(_col(aces, "ace_type"), F.lit(""))),
        normalize_mask(_col(aces, "ace_mask")),
        F.when(F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False)), F.lit("1")).otherwise(F.lit("0")),
    )
    h = F.md5(line)
    slices = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i}") for i in range(4)]
    return aces.select(
        _col(aces, "run_id").alias("run_id"), "folder_path",
        F.coalesce(_col(aces, "ace_sid"), F.lit("")).alias("ace_sid"), res.alias("ace_name"),
        F.lower(F.coalesce(_col(aces, "ace_type"), F.lit(""))).alias("ace_type"),
        normalize_mask(_col(aces, "ace_mask")).alias("ace_mask"),
        F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False)).alias("ace_inherited"),
        _col(aces, "owner").alias("owner"),
        line.alias("ace_line"), *slices)


def _fingerprint(count: Column, sums) -> Column:
    return F.sha2(F.concat_ws(":", count.cast("string"), *[s.cast("string") for s in sums]), 256)


def object_acl(aces: DataFrame) -> DataFrame:
    """One row per (run, folder): object id, ACL fingerprint, ACE count, owner."""
    lines = ace_lines(aces)
    g = lines.groupBy("run_id", "folder_path").agg(
        F.count(F.lit(1)).alias("acl_ace_count"),
        *[F.sum(f"h{i}").alias(f"s{i}") for i in range(4)],
        F.min("owner").alias("owner"))
    filer, share = unc_filer_share("folder_path")
    return g.select(
        "run_id",
        F.sha2(F.concat_ws("|", F.coalesce(filer, F.lit("")), F.coalesce(share, F.lit("")),
                           F.coalesce("folder_path", F.lit(""))), 256).alias("object_id"),
        "folder_path",
        _fingerprint(F.col("acl_ace_count"), [F.col(f"s{i}") for i in range(4)]).alias("acl_fingerprint"),
        "acl_ace_count", "owner")


def objects(aces: DataFrame) -> DataFrame:
    """One row per (run, folder): object_id = sha256(server|share|folder_path)."""
    f = aces.groupBy(_col(aces, "run_id").alias("run_id"), "folder_path").agg(
        F.min(_col(aces, "collected_utc")).alias("discovered_at"),
        F.min(_col(aces, "source_file")).alias("source_file"))
    filer, share = unc_filer_share("folder_path")
    return f.select(
        "run_id",
        F.sha2(F.concat_ws("|", F.coalesce(filer, F.lit("")), F.coalesce(share, F.lit("")),
                           F.coalesce("folder_path", F.lit(""))), 256).alias("object_id"),
        filer.alias("server"), share.alias("share"), "folder_path",
        path_depth("folder_path").alias("depth"), "discovered_at", "source_file")


def acl_definitions(aces: DataFrame) -> DataFrame:
    """Unique ACLs: fingerprint, ACE count, version, number of folders using it."""
    oa = object_acl(aces)
    return (oa.groupBy("run_id", "acl_fingerprint", "acl_ace_count")
            .agg(F.count(F.lit(1)).alias("object_count"))
            .withColumn("canonicalization_version", F.lit(CANONICALIZATION_VERSION)))


def acl_ace_rows(aces: DataFrame) -> DataFrame:
    """Normalized ACE rows keyed by fingerprint, with the multiplicity ``n`` of
    each line inside its ACL."""
    lines = ace_lines(aces)
    per_folder = lines.groupBy("run_id", "folder_path", "ace_line", "ace_sid", "ace_name", "ace_type",
                               "ace_mask", "ace_inherited").agg(F.count(F.lit(1)).alias("n"))
    fp = object_acl(aces).select(F.col("run_id").alias("_r"), F.col("folder_path").alias("_f"), "acl_fingerprint")
    # null-safe: the ACEs of a folder without a path form one ACL as well
    cond = per_folder["run_id"].eqNullSafe(fp["_r"]) & per_folder["folder_path"].eqNullSafe(fp["_f"])
    return (per_folder.join(fp, cond).drop("folder_path", "_r", "_f")
            .dropDuplicates(["run_id", "acl_fingerprint", "ace_line"]))


def unique_acl_count(aces: DataFrame) -> DataFrame:
    oa = object_acl(aces)
    return oa.groupBy("run_id").agg(F.count(F.lit(1)).alias("objects"),
                                    F.countDistinct("acl_fingerprint").alias("unique_acls"))


def top_acls_by_folders(aces: DataFrame, k: int = 20) -> DataFrame:
    d = acl_definitions(aces)
    return d.orderBy(F.desc("object_count"), F.asc("acl_fingerprint")).limit(k).select(
        "run_id", "acl_fingerprint", "acl_ace_count", "object_count")


def local_rules(ruleset):
    """Rules that depend on one ACE only (no path, no folder counts)."""
    return [r for r in ruleset.rules if not r.path_keywords and r.ace_count_gt is None
            and not r.requires_aggregation and not r.expect_presence]


def rules_on_definitions(aces: DataFrame, ruleset=None) -> DataFrame:
    """Score each unique ACL once, then expand the matches to every folder that
    uses it.  Equal to ``apply_rules`` restricted to ACE-local rules."""
    from permscope.operators.rules import apply_rules
    from permscope.sources.ruleset import Ruleset, load_ruleset

    rs = load_ruleset(ruleset)
    rs_local = Ruleset(tuple(local_rules(rs)), rs.admin_identities, rs.version, rs.raw)
    defs = acl_ace_rows(aces).withColumn("folder_path", F.col("acl_fingerprint"))
    m = apply_rules(defs, rs_local, keep=("run_id", "acl_fingerprint", "n"))
    oa = object_acl(aces).select("run_id", "acl_fingerprint", F.col("folder_path").alias("object_folder"))
    out = m.drop("folder_path").join(oa, ["run_id", "acl_fingerprint"])
    out = out.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select("run_id", "rule_id", "severity",
                      F.coalesce("object_folder", F.lit("")).alias("folder_path"),
                      "ace_name", "ace_sid", "ace_mask", "ace_inherited")


def findings_standard(matches: DataFrame, aces: DataFrame) -> DataFrame:
    """Findings in the standard shape: run_id, rule_id, severity, object_id,
    folder_path, ace_*, reason, source_file."""
    from permscope.operators.access import null_safe_join

    obj = objects(aces).select("run_id", "folder_path", "object_id", "source_file")
    m = matches if "run_id" in matches.columns else matches.withColumn("run_id", F.lit(None).cast("string"))
    obj = obj.withColumn("folder_path", F.coalesce("folder_path", F.lit("")))
    j = null_safe_join(m, obj, ["run_id", "folder_path"], "left")
    return j.select("run_id", "rule_id", "severity", "object_id", "folder_path", "ace_name", "ace_sid",
                    "ace_mask", "ace_inherited",
                    F.concat(F.lit("rule "), F.col("rule_id"), F.lit(" matched mask "), F.col("ace_mask"))
                    .alias("reason"), "source_file")
