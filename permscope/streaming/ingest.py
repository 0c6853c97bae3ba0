"""Incremental ingest with Structured Streaming.

Folder-ACL exports land under ``<root>/<run>/folderacls/``.  A file-source
stream picks up new files, ``foreachBatch`` parses each micro-batch with the
batch ingest (``sources.acl_json``) and writes the ACE rows to Parquet
partitioned by ``run_id`` and the micro-batch ``epoch``.  The checkpoint
location records progress, so a restarted job resumes instead of
restarting; a retried epoch rewrites only its own partition (dynamic
partition overwrite), so the sink is exactly-once.  With
``trigger(availableNow=True)`` the job drains what is there and stops —
the result equals the batch ingest of the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.session import apply_engine_conf
from permscope.sources.acl_json import ACE_SCHEMA_COLUMNS, acl_nodes, malformed_files, nodes_to_aces

SCHEMA_NAMES = "(?i)schema"


def _files_stream(spark: SparkSession, root: str, json_lines: bool, glob: str = "*.json") -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if not json_lines:
        reader = reader.option("wholetext", True)
    df = reader.option("recursiveFileLookup", True).load(root.rstrip("/"))
    src = F.col("_metadata.file_path")
    df = df.select(src.alias("source_file"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"),
                   F.regexp_extract(src, r"([^/]+)/folderacls/[^/]*$", 1).alias("run_id"))
    # the batch ingest's file selection: any depth, schema artifacts skipped
    return df.filter(F.col("source_file").contains("folderacls/") & ~F.col("file_name").rlike(SCHEMA_NAMES))


def incremental_ingest(spark: SparkSession, root: str, out_dir: str, checkpoint_location: str,
                       json_lines: bool = False, available_now: bool = True,
                       processing_time: str | None = None, glob: str = "*.json",
                       findings_dir: str | None = None, ruleset=None, quarantine_dir: str | None = None):
    """Start (and, with ``available_now``, run to completion) the ingest stream.

    Returns the ``StreamingQuery``.  ``json_lines=True`` reads one JSON
    document per line (JSON Lines exports), otherwise one document per file.

    With ``findings_dir`` every micro-batch also re-scores the folders it
    touched: the complete ACE set of those folders is read back from the
    store (a semi join on (run, folder)), so count-based rules see whole
    folders, and the findings are written under (run, epoch).  Read them
    with ``read_findings`` (latest epoch per folder).  With ``quarantine_dir``
    files that are no single JSON value are listed there, by epoch.
    """
    apply_engine_conf(spark)
    files = _files_stream(spark, root, json_lines, glob)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        aces = nodes_to_aces(acl_nodes(batch)).drop("ace_pos").withColumn("epoch", F.lit(int(epoch_id)))
        (aces.select(*ACE_SCHEMA_COLUMNS, "epoch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "epoch").parquet(out_dir))
        if quarantine_dir:
            (malformed_files(batch).withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(quarantine_dir))
        if findings_dir:
            _rescore(spark, out_dir, findings_dir, int(epoch_id), ruleset)

    w = files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def read_ingested(spark: SparkSession, out_dir: str) -> DataFrame:
    """The ACE rows written by the stream (all epochs)."""
    return spark.read.parquet(out_dir).drop("epoch")


FINDINGS_SCHEMA = ("rule_id string, severity string, folder_path string, ace_name string, ace_sid string, "
                   "ace_mask string, ace_inherited boolean, run_id string, epoch int")


def _rescore(spark: SparkSession, store: str, findings_dir: str, epoch_id: int, ruleset) -> None:
    from permscope.operators.rules import apply_rules

    all_aces = spark.read.parquet(store)
    epoch = all_aces.filter(F.col("epoch") == epoch_id)
    # the runs of this micro-batch (a few names) prune the store's partitions
    runs = [r["run_id"] for r in epoch.select("run_id").distinct().collect()]
    named = F.col("run_id").isin([r for r in runs if r is not None])
    all_aces = all_aces.filter(named | F.col("run_id").isNull() if None in runs else named)
    touched = (epoch.select("run_id", "folder_path").distinct()
               .select(F.col("run_id").alias("_r"), F.col("folder_path").alias("_f")))
    cond = all_aces["run_id"].eqNullSafe(touched["_r"]) & all_aces["folder_path"].eqNullSafe(touched["_f"])
    folders = all_aces.join(touched, cond, "left_semi").drop("epoch")
    found = apply_rules(folders, ruleset, keep=("run_id",), counts_first=False).withColumn("epoch", F.lit(epoch_id))
    (found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "epoch").parquet(findings_dir))


def read_findings(spark: SparkSession, findings_dir: str) -> DataFrame:
    """Current findings: for each (run, folder) the rows of its latest scoring
    epoch (aggregate + semi join; no window over a folder's rows)."""
    # explicit schema: an epoch without findings writes no data file
    f = spark.read.schema(FINDINGS_SCHEMA).parquet(findings_dir)
    latest = (f.groupBy("run_id", "folder_path").agg(F.max("epoch").alias("_e"))
              .select(F.col("run_id").alias("_r"), F.col("folder_path").alias("_f"), "_e"))
    cond = f["run_id"].eqNullSafe(latest["_r"]) & f["folder_path"].eqNullSafe(latest["_f"]) & (f["epoch"] == latest["_e"])
    return f.join(latest, cond, "left_semi").drop("epoch")
