"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.session import checkpoint_dir

FOREST = 1 << 20  # edges that a task reduces at a time


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_file(path: str, data: bytes) -> None:
    """Write a file so that it appears whole; another attempt writes the same bytes."""
    fs, name = pafs.FileSystem.from_uri(path)
    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, name)


def get_file(path: str) -> bytes:
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as f:
        return f.read()


def shards_for(df: DataFrame, each: int) -> int:
    """Shards for work on ``df``: one for every ``each`` bytes of its sources, at least the session's partitions."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < 1 << 60 else 0  # no estimate
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-known // each), 1 << 20))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the edges ``a[i] - b[i]``, without the smallest nodes themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        x, y = low[x], low[y]
        apart = x != y
        x, y = x[apart], y[apart]
        if not len(x):
            break
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    other = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[other], nodes[low[other]]


def _forests(edges: DataFrame) -> DataFrame:
    """Edges (a > b) with the same components: the forest of each FOREST edges of a task."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for x in itertools.chain(batches, [None]):
            if x is not None:
                held.append((x.column("a").to_numpy(), x.column("b").to_numpy()))
                n += x.num_rows
            if n and (x is None or n >= FOREST):
                a, b = forest(*(np.concatenate(c) for c in zip(*held)))
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])
                held, n = [], 0

    return edges.select("a", "b").mapInArrow(reduce, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` of every node of the undirected ``edges`` (a, b); comp is its smallest node.

    Alternating large-star and small-star rounds: a logarithmic number of
    joins, each on pre-aggregated minima.  A round makes one edge of each edge,
    so their number never grows and no shuffle has to remove equal ones; tasks
    reduce what they hold to forests, and rounds are written to the shared
    folder.  The rounds end when the edges are stars: each node points to one
    centre, and no centre points on.
    """
    now = stored(_forests(edges.where("a != b")), "edges")
    while True:
        ends = now.select(F.col("a").alias("node"), F.col("b").alias("to"), F.lit(False).alias("head")).unionByName(
            now.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("to"), F.lit(True).alias("head")))
        seen = ends.groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.max("head").alias("head"))
        if seen.where("lo != hi or lo is not null and head").isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                            F.col("m").alias("b"))
        now = stored(_forests(small), "edges")
    own = now.select(F.col("b").alias("node"), F.col("b").alias("comp"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(own).distinct()


def joined(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, comp`` like ``components`` after more ``edges``, which are taken between the components of ``comp``."""
    if edges.isEmpty():
        return comp
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(comp.toDF(end, f"{end}_comp"), end, "left").withColumn(end, F.coalesce(f"{end}_comp", end))
    more = components(ends.select("a", "b")).toDF("own", "low")
    # a node that had no edge is its own component
    return stored(comp.toDF("node", "own").join(more, "own", "full").select(
        F.coalesce("node", "own").alias("node"), F.coalesce("low", "own").alias("comp")), "components")
