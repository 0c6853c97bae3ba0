"""ACE Parquet store, shares inventory and findings sinks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from permscope.sources.acl_json import ACE_SCHEMA_COLUMNS
from permscope.sources.json_split import open_file

ACE_TYPES = {c: T.StringType() for c in ACE_SCHEMA_COLUMNS}
ACE_TYPES["ace_inherited"] = T.BooleanType()
ACE_TYPES["attributes"] = T.ArrayType(T.StringType())

SHARES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                              ("filer_name", "share_name", "volume_name", "volume_guid")])


def conform(df: DataFrame) -> DataFrame:
    """Lower-case column names, add missing canonical columns as typed nulls,
    cast masks to text; extra columns are kept."""
    df = df.toDF(*[c.lower() for c in df.columns])
    cols = []
    for c in ACE_SCHEMA_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c).cast(ACE_TYPES[c]).alias(c) if c in ("ace_mask", "ace_inherited") else F.col(c))
        else:
            cols.append(F.lit(None).cast(ACE_TYPES[c]).alias(c))
    extra = [F.col(c) for c in df.columns if c not in ACE_SCHEMA_COLUMNS]
    return df.select(*cols, *extra)


def _reader(spark: SparkSession):
    # options of this read alone: other scans of the session stay strict
    return spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """file, schema, error of every Parquet file below ``path``: footers are read in tasks, one small read a file.

    ``schema`` lists the columns (lower case, sorted) with their types;
    ``error`` says why a file has none.
    """
    from permscope.session import let_workers_import

    let_workers_import(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(path).select(F.col("_metadata.file_path").alias("file")))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for uri in b.column("file").to_pylist():
                try:
                    f, _ = open_file(uri)
                    schema = pq.read_schema(f)
                    out.append((uri, ", ".join(sorted(f"{x.name.lower()} {x.type}" for x in schema)), None))
                except (pa.ArrowException, OSError) as e:
                    out.append((uri, None, f"{type(e).__name__}: {e}"[:500]))
            yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 3,
                                  names=["file", "schema", "error"])

    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(spread, "file").mapInArrow(footers, "file string, schema string, error string")


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """file, error of the Parquet files that ``read_aces`` leaves out because their footer cannot be read."""
    return file_schemas(spark, path).where("schema is null").select("file", "error")


def _read_by_schema(spark: SparkSession, path: str) -> DataFrame:
    """Files grouped by their own schema in Spark, each group cast to the
    canonical types, and the groups' union; the driver sees one row per schema."""
    groups = (file_schemas(spark, path).where("schema is not null").groupBy("schema")
              .agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("schema").collect())
    out = None
    for g in groups:
        part = conform(_reader(spark).option("basePath", path).parquet(*map(unquote, g["files"])))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_aces(spark: SparkSession, path: str, run_ids=None) -> DataFrame:
    """ACE table from Parquet (``run_id=...`` partitions), schemas merged,
    unreadable files skipped.  ``run_ids`` prunes partitions."""
    try:
        df = conform(_reader(spark).parquet(path))
    except Exception as e:  # files that store a column (say, the mask) with different types
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        df = _read_by_schema(spark, path)
    if run_ids:
        df = df.filter(F.col("run_id").isin(list(run_ids)))
    return df


def write_aces(aces: DataFrame, path: str, mode: str = "overwrite", extra_partitions=()) -> None:
    """Write the ACE table partitioned by run (dynamic partition overwrite: a
    rewritten run replaces only its own partition).  Rows are clustered by
    folder inside each file so point lookups prune row groups."""
    spark = aces.sparkSession
    parts = ["run_id", *extra_partitions]
    # a rebalance, not a repartition: adaptive execution splits the partition
    # of a hot folder into several files
    (aces.hint("rebalance", *[F.col(c) for c in (*parts, "folder_path")]).sortWithinPartitions("folder_path")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


def read_shares_csv(spark: SparkSession, path: str) -> DataFrame:
    """shares.csv -> (filer_name, share_name, volume_name, volume_guid, row_no).

    A missing file gives an empty table; nulls become ''.  ``row_no`` keeps
    file order (the first matching share wins)."""
    try:
        df = spark.read.option("header", True).schema(SHARES_SCHEMA).csv(path)
        df.schema  # noqa: B018 - resolves the path
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        # missing inventory -> empty table
        empty = T.StructType(SHARES_SCHEMA.fields + [T.StructField("row_no", T.LongType())])
        return spark.createDataFrame([], empty)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in SHARES_SCHEMA.names],
                     F.monotonically_increasing_id().alias("row_no"))


def write_findings_csv(matches: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Findings with a header, one file per task; an empty result still writes a header-only file."""
    matches.write.mode(mode).option("header", True).csv(path)


def read_broad_csv(spark: SparkSession, path: str) -> DataFrame:
    """A broad-permissions CSV (as written by the broad-perms finder), by header."""
    return spark.read.option("header", True).csv(path)


def register_ace_view(spark: SparkSession, path: str, name: str = "aces") -> DataFrame:
    """Expose an ACE Parquet store to ``spark.sql`` as a temporary view."""
    df = read_aces(spark, path)
    df.createOrReplaceTempView(name)
    return df
