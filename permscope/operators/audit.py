"""Run manifest, data-contract audit and ingest readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.functions.paths import valid_folder


def distinct_counts(df: DataFrame, key: str, columns: dict) -> DataFrame:
    """``key`` with one distinct count per named Column.

    Several ``countDistinct`` in one aggregation plan as an Expand that
    copies every row once per distinct column; separate pre-aggregated
    distincts (each reads only its column from the columnar store) joined on
    the small per-key results are several times faster and shuffle less."""
    out = None
    for name, c in columns.items():
        d = (df.select(key, c.alias("_v")).filter(F.col("_v").isNotNull()).distinct()
             .groupBy(key).agg(F.count(F.lit(1)).alias(name)))
        out = d if out is None else out.join(d, key, "full_outer")
    return out


def run_manifest(aces: DataFrame) -> DataFrame:
    """Per run: appliances, volumes, shares, folders, ACE rows, files and the
    collection time range."""
    share_key = F.concat_ws("\\", F.coalesce("appliance_hostname", F.lit("")), F.coalesce("share_name", F.lit("")))
    base = aces.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("ace_rows"),
        F.min("collected_utc").alias("collected_from"),
        F.max("collected_utc").alias("collected_to"))
    names = ["appliances", "volumes", "shares", "folders", "files"]
    dc = distinct_counts(aces, "run_id", dict(zip(names, [F.col("appliance_hostname"), F.col("volume_name"), share_key,
                                                          F.col("folder_path"), F.col("source_file")])))
    out = base.join(dc, "run_id", "left")
    return out.select("run_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names[:4]],
                      "ace_rows", F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
                      "collected_from", "collected_to")


def contract_audit(aces: DataFrame) -> DataFrame:
    """Per run: rows breaking the ACE contract, column by column."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    return aces.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("ace_rows"),
        F.sum(F.when(~valid_folder("folder_path"), 1).otherwise(0)).alias("bad_folder_path"),
        F.sum(F.when(F.col("ace_sid").isNull() | (F.col("ace_sid") == ""), 1).otherwise(0)).alias("missing_sid"),
        F.sum(F.when(blank("ace_name"), 1).otherwise(0)).alias("missing_name"),
        F.sum(F.when(F.col("ace_mask").isNull() | (F.col("ace_mask") == ""), 1).otherwise(0)).alias("missing_mask"),
        F.sum(F.when(F.col("ace_inherited").isNull(), 1).otherwise(0)).alias("missing_inherited"),
        F.sum(F.when(F.col("collected_utc").isNull(), 1).otherwise(0)).alias("missing_collected_utc"),
        F.sum(F.when(F.col("ace_type").isNull() | ~F.lower("ace_type").isin("allow", "deny"), 1).otherwise(0))
        .alias("unknown_ace_type"))


def required_columns_missing(df: DataFrame, required) -> list[str]:
    """Schema-level contract check (driver side, metadata only)."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def ingest_ready_check(aces: DataFrame, expected_files: int) -> DataFrame:
    """Files found per run against the expected file count of the inventory."""
    found = aces.groupBy("run_id").agg(F.countDistinct("source_file").alias("files_found"))
    return found.select("run_id", "files_found", F.lit(int(expected_files)).cast("bigint").alias("expected_files"),
                        (F.col("files_found") == F.lit(int(expected_files))).alias("ready"))
