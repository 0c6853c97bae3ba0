"""Session helpers.

Cluster settings (shuffle partitions, executor memory, checkpoint folder)
belong to whoever launches the job; ``get_spark`` only fills in what is
unset, so the same code runs under ``local[8]`` tests and on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings the engine relies on.  They are all runtime SQL confs, so
# they can be applied to a session someone else built.
ENGINE_SQL_CONF = {
    # adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a join side measures small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ACE JSON can repeat a key in different case; the last one wins,
    # as with Python's json module.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


ARROW_BATCH_BYTES = 16 << 20


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    for k, v in ENGINE_SQL_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on a shared session
            pass
    return spark


def get_spark(master: str | None = None, app_name: str = "permscope",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or build) the active session with the engine's SQL settings.

    ``master``/``shuffle_partitions`` are for local runs and tests only; on a
    cluster leave them ``None`` and let the launcher decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("PERMSCOPE_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    checkpoint_dir(spark)
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed on the nodes or shipped with
    ``--py-files``; this only matters when the driver runs from a checkout.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    # batches to and from Python of a bounded size, whatever the rows
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints / intermediate tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a
    shared, fault-tolerant folder there).  Only in local mode, when it is
    unset, a private scratch folder is created and registered; any other
    master without the setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d and sc is not None and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="permscope-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() if sc is not None else None) or d


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, int] = {}
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """A query that ends in here removes its shuffle files at once, on all executors.

    Otherwise they stay until the driver's JVM happens to collect garbage, so the
    files of all steps that were already written to tables add up on disk.  Only
    for writes: what is read again afterwards is the table.
    """
    app = spark.sparkContext.applicationId
    with _freeing_lock:
        _freeing[app] = _freeing.get(app, 0) + 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            _freeing[app] -= 1
            if not _freeing[app]:
                spark.conf.unset(_CLEANUP)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, survives lost executors.

    Unlike ``checkpoint()`` the plan runs once, and Spark knows the table's size afterwards.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
