"""Scalability metrics and share -> volume matching.

An *entry* is one folder ACL record: ``(source_file, folder_path)`` of the
ACE table with a usable path.  Metrics are plain aggregations.

Share matching is a theta join (filer equal, then share name equal /
contained, first share in file order wins).  It only depends on the
``(filer, share)`` pair of an entry, so the match runs on the *distinct*
pairs (bounded by the number of shares) and the result is equi-joined back
to the entries — the theta work never touches the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.paths import valid_folder


def unc_filer_share(path_col="folder_path"):
    """(filer, share) of a ``\\\\host.domain\\share\\...`` path; null unless it
    starts with ``\\\\`` and has two parts.  Plain string functions (no regex):
    strip backslashes, first part up to the first dot, second part."""
    p = F.coalesce(F.col(path_col), F.lit(""))
    stripped = F.btrim(p, F.lit("\\"))
    ok = p.startswith("\\\\") & stripped.contains("\\")
    filer = F.lower(F.substring_index(F.substring_index(stripped, "\\", 1), ".", 1))
    share = F.lower(F.substring_index(F.substring_index(stripped, "\\", 2), "\\", -1))
    return F.when(ok, filer), F.when(ok, share)


def entries(aces: DataFrame) -> DataFrame:
    """One row per ACL entry with its ACE count, filer and share."""
    e = (aces.filter(valid_folder("folder_path"))
         .groupBy("run_id", "source_file", "folder_path")
         .agg(F.count(F.lit(1)).alias("aces")))
    filer, share = unc_filer_share("folder_path")
    return e.withColumn("filer", filer).withColumn("share", share)


def share_volume_map(pairs: DataFrame, shares: DataFrame, order_col: str = "row_no") -> DataFrame:
    """(filer, share) -> (volume_name, volume_guid) by the first matching share row."""
    s = shares.select(
        F.lower(F.coalesce("filer_name", F.lit(""))).alias("s_filer"),
        F.lower(F.coalesce("share_name", F.lit(""))).alias("sn"),
        F.lower(F.coalesce("volume_name", F.lit(""))).alias("vn"),
        F.coalesce("volume_guid", F.lit("")).alias("guid"),
        F.col(order_col).alias("row_no"))
    cond = ((pairs["filer"] == s["s_filer"])
            & ((s["sn"] == pairs["share"]) | (s["vn"] == pairs["share"])
               | s["sn"].contains(pairs["share"]) | s["vn"].contains(pairs["share"])))
    m = pairs.join(s, cond, "inner")
    label = F.coalesce(F.nullif("vn", F.lit("")), F.nullif("sn", F.lit("")), F.lit("unknown"))
    first = (m.groupBy("filer", "share")
             .agg(F.min_by(F.struct(label.alias("volume_name"), F.col("guid").alias("volume_guid")),
                           F.col("row_no")).alias("v")))
    return first.select("filer", "share", "v.volume_name", "v.volume_guid")


def share_volume_match(aces: DataFrame, shares: DataFrame) -> DataFrame:
    """Each entry with its matched volume ('unknown' when no share matches)."""
    e = entries(aces)
    # an empty filer or share matches nothing (it is contained in every name)
    pairs = (e.filter(F.col("filer").isNotNull() & (F.col("filer") != "") & (F.col("share") != ""))
             .select("filer", "share").distinct())
    vm = share_volume_map(pairs, shares)
    out = e.join(vm, ["filer", "share"], "left")
    return out.select("run_id", "source_file", "folder_path", "filer", "share", "aces",
                      F.coalesce("volume_name", F.lit("unknown")).alias("volume_name"),
                      F.coalesce("volume_guid", F.lit("")).alias("volume_guid"))


def unknown_volume_entries(aces: DataFrame, shares: DataFrame) -> DataFrame:
    """Entries that no share row matches: run, file, folder_path, aces_count."""
    m = share_volume_match(aces, shares)
    return m.filter(F.col("volume_name") == "unknown").select(
        F.col("run_id").alias("run"), F.col("source_file").alias("file"), "folder_path",
        F.col("aces").alias("aces_count"))


def _stats(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("acl_entries"),
        F.sum("aces").alias("total_aces"),
        F.round(F.avg("aces"), 2).alias("avg_aces_per_entry"),
        F.max("aces").alias("max_aces_per_entry"),
        F.min("aces").alias("min_aces_per_entry"))


def scalability_totals(aces: DataFrame) -> DataFrame:
    """Per run: files, entries, ACEs, avg (2 dp) / max / min ACEs per entry."""
    files = aces.groupBy("run_id").agg(F.countDistinct("source_file").alias("folderacl_files"))
    st = _stats(entries(aces), ["run_id"])
    out = files.join(st, "run_id", "left")
    return out.select(
        F.col("run_id").alias("run"), "folderacl_files",
        F.coalesce("acl_entries", F.lit(0)).alias("acl_entries"),
        F.coalesce("total_aces", F.lit(0)).alias("total_aces"),
        F.coalesce("avg_aces_per_entry", F.lit(0.0)).alias("avg_aces_per_entry"),
        F.coalesce("max_aces_per_entry", F.lit(0)).alias("max_aces_per_entry"),
        F.coalesce("min_aces_per_entry", F.lit(0)).alias("min_aces_per_entry"))


def scalability_per_host(aces: DataFrame) -> DataFrame:
    e = entries(aces).withColumn("host", F.coalesce("filer", F.lit("unknown")))
    return _stats(e, ["run_id", "host"]).withColumnRenamed("run_id", "run").orderBy("run", "host")


def scalability_per_volume(aces: DataFrame, shares: DataFrame) -> DataFrame:
    """Per matched volume; the guid is that of the first entry seen (file order)."""
    m = share_volume_match(aces, shares)
    st = m.groupBy("run_id", "volume_name").agg(
        F.min_by("volume_guid", F.struct("source_file", "folder_path")).alias("volume_guid"),
        F.count(F.lit(1)).alias("acl_entries"),
        F.sum("aces").alias("total_aces"),
        F.round(F.avg("aces"), 2).alias("avg_aces_per_entry"),
        F.max("aces").alias("max_aces_per_entry"),
        F.min("aces").alias("min_aces_per_entry"))
    return st.withColumnRenamed("run_id", "run").orderBy("run", "volume_name")
