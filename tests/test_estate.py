"""The derived estate is written by tasks of a bounded size, whatever the session's settings."""

import glob
import os

import pyarrow.parquet as pq

from permscope.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def test_estate_tasks_are_bounded(spark, monkeypatch):
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "12k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    monkeypatch.setattr(fx, "_ESTATE", {})
    monkeypatch.setattr(fx, "TASK_ROWS", 5000, raising=False)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = fx.aces(spark, SF)
        files = [f for p in fx._ESTATE.values() for f in glob.glob(f"{p.removeprefix('file:')}/*.parquet")]
        rows = [pq.ParquetFile(f).metadata.num_rows for f in files]
        assert max(rows) < sum(rows) / 4
        assert df.count() == sum(rows) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
        assert {k: spark.conf.get(k) for k in conf} == conf
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shuffles_grow_with_the_estate(spark, monkeypatch):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", initial: None}
    before = {k: spark.conf.get(k, None) for k in conf}
    monkeypatch.setattr(fx, "_ESTATE", {})
    monkeypatch.setattr(fx, "TASK_ROWS", 5000)
    try:
        for k, v in conf.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        df = fx.aces(spark, SF)
        assert df.groupBy("folder_path").count().rdd.getNumPartitions() >= df.count() // 5000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_written_tables_leave_no_shuffle_files(spark, monkeypatch):
    import time

    from permscope.session import checkpointed

    def left():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}

    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(fx, "_ESTATE", {})
    before = left()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = fx.aces(spark, SF)
        assert checkpointed(df.groupBy("folder_path").count()).count() > 1000
        for _ in range(50):
            if not left() - before:
                break
            time.sleep(0.1)
        # the count of the written table is the only shuffle that may be left
        assert sum(os.path.getsize(f) for f in left() - before) < 10_000
        assert spark.conf.get(cleanup) == "false"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
