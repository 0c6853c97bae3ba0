"""Canonical ACLs with inheritance flags, protection and owner (``acl-canon-v2``).

A canonical line is ``identity | type | mask | inherited | flags``.  The identity
is the SID, or the resolved name where there is no SID: renaming a principal
changes no ACL.  ``flags`` lists inheritance and propagation flags as SDDL codes
in a fixed order.  The fingerprint is a hash over the multiset of lines that
partial aggregation builds (see ``fingerprint``), so no folder is one task.

``acl_definitions`` also writes the ACL out as JSON.  An ACL of more than about
``BLOCK`` different lines becomes several blocks, cut by the lines' hashes and
numbered, because one folder may hold a third of all entries.  Lines come from
one folder per fingerprint; the others are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.functions.masks import normalize_mask
from permscope.functions.names import resolve_name
from permscope.functions.sddl import flag_codes, sddl_owner, sddl_protected
from permscope.operators.access import null_safe_join
from permscope.operators.metrics import unc_filer_share
from permscope.session import checkpointed

CANONICALIZATION_VERSION = "acl-canon-v2"
BLOCK = 1000  # different lines a block has on average, at most
LINE_FIELDS = ["sid", "name", "type", "mask", "inherited", "flags"]


def _col(df: DataFrame, name: str, typ: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def _with_raw_flags(rows: DataFrame) -> DataFrame:
    """``_raw_flags`` from ``_raw``: flag codes of the exporter's ``InheritanceFlags`` and ``PropagationFlags`` (any case).

    One projection a step, not lambdas over the parsed entry: those are evaluated interpreted.
    """
    fields = F.transform_keys(F.from_json(F.when(F.col("_raw").startswith("{"), F.col("_raw")), "map<string,string>"), lambda k, v: F.lower(k))
    rows = rows.withColumn("_raw", fields)
    rows = rows.withColumn("_raw", F.concat_ws(", ", F.col("_raw")["inheritanceflags"], F.col("_raw")["propagationflags"]))
    return rows.withColumn("_raw_flags", flag_codes(F.col("_raw"))).drop("_raw")


def canonical_lines(aces: DataFrame) -> DataFrame:
    """run_id, folder_path, the line's fields, its text, the slices of its hash, and sddl / owner / collected_utc."""
    sid = F.trim(F.coalesce(_col(aces, "ace_sid"), F.lit("")))
    flags = F.nullif(flag_codes(_col(aces, "ace_flags")), F.lit(""))
    rows = aces.select(
        _col(aces, "run_id").alias("run_id"), "folder_path", sid.alias("sid"),
        F.when(sid == "", resolve_name(_col(aces, "ace_name"), _col(aces, "ace_raw"))).otherwise("").alias("name"),
        F.lower(F.coalesce(_col(aces, "ace_type"), F.lit(""))).alias("type"),
        normalize_mask(_col(aces, "ace_mask")).alias("mask"),
        F.coalesce(_col(aces, "ace_inherited", "boolean"), F.lit(False)).alias("inherited"),
        flags.alias("flags"), _col(aces, "ace_raw").alias("_raw"),
        _col(aces, "sddl").alias("sddl"), _col(aces, "owner").alias("owner"), _col(aces, "collected_utc").alias("collected_utc"))
    rows = _with_raw_flags(rows).withColumn("flags", F.coalesce("flags", "_raw_flags", F.lit(""))).drop("_raw_flags")
    text = F.concat_ws("|", F.when(F.col("sid") != "", F.col("sid")).otherwise(F.concat(F.lit("name:"), F.col("name"))), "type", "mask",
                       F.col("inherited").cast("int").cast("string"), "flags")
    rows = rows.withColumn("line", text).withColumn("_h", F.md5("line"))
    return rows.withColumns({f"h{i}": F.conv(F.substring("_h", 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)}).drop("_h")


def object_acl(aces: DataFrame) -> DataFrame:
    """One row per run and folder: object_id, acl_fingerprint, is_protected, owner_sid, collected_at.

    ``is_protected`` and ``owner_sid`` come from the record's SDDL (null without
    one; an owner that is a SID itself counts); the latest collection time is kept.
    """
    owner_sid = F.coalesce(sddl_owner(F.col("sddl")), F.when(F.col("owner").rlike("(?i)^s-1-[0-9-]+$"), F.upper("owner")))
    rows = canonical_lines(aces).withColumns({"_owner": owner_sid, "_protected": sddl_protected(F.col("sddl"))})
    g = rows.groupBy("run_id", "folder_path").agg(
        F.count("*").alias("acl_ace_count"), *[F.sum(f"h{i}").alias(f"s{i}") for i in range(4)],
        F.bool_or("_protected").alias("is_protected"), F.min("_owner").alias("owner_sid"),
        F.max("collected_utc").alias("collected_at"))
    filer, share = unc_filer_share("folder_path")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return g.select(
        "run_id", F.sha2(F.concat_ws("|", blank(filer), blank(share), blank(F.col("folder_path"))), 256).alias("object_id"),
        "folder_path", F.sha2(F.concat_ws(":", "acl_ace_count", *[F.col(f"s{i}").cast("string") for i in range(4)]), 256)
        .alias("acl_fingerprint"), "acl_ace_count", "is_protected", "owner_sid", "collected_at",
        F.lit(CANONICALIZATION_VERSION).alias("canonicalization_version"))


def acl_definitions(aces: DataFrame, block: int = BLOCK) -> DataFrame:
    """The different ACLs of all runs as canonical JSON, in numbered blocks (one for most)."""
    acls = checkpointed(object_acl(aces))
    one = acls.groupBy("acl_fingerprint", "acl_ace_count").agg(
        F.count("*").alias("object_count"), F.min(F.struct("run_id", "folder_path")).alias("x"))
    chosen = one.select("acl_fingerprint", "x.run_id", "x.folder_path")
    lines = null_safe_join(canonical_lines(aces), chosen, ["run_id", "folder_path"])
    lines = checkpointed(lines.groupBy("acl_fingerprint", *LINE_FIELDS, "h0").agg(F.count("*").alias("n")))
    count = lines.groupBy("acl_fingerprint").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    placed = lines.join(count, "acl_fingerprint").withColumn("block", F.floor(F.col("h0") * F.col("blocks") / F.lit(1 << 32)).cast("int"))
    written = placed.groupBy("acl_fingerprint", "block", "blocks").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(*LINE_FIELDS, "n")))).alias("canonical_acl_json"))
    return (one.drop("x").join(written, "acl_fingerprint")
            .select("acl_fingerprint", "acl_ace_count", "object_count", "block", "blocks", "canonical_acl_json",
                    F.lit(CANONICALIZATION_VERSION).alias("canonicalization_version")))
