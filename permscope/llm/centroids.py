"""Operator 12: exact centroid clustering over dictionaries of subvectors.

Vectors are turned into integers once and stored in chunks.  A chunk cuts the
dimensions into blocks of ``WIDTH`` and keeps, for each block, a dictionary of
its distinct subvectors and one code per vector: lossless, and smaller than the
floats it came from.  A round reads the codes alone.  For each chunk it computes
the squared distance of every dictionary entry to every centroid's block, once,
and a vector's distance is the sum of the entries its codes point to.  The sums
for the new centroids are taken by code as well (how often each entry falls
into each cluster, times the entry).  Tasks send one row per cluster and
dimension, Spark adds them, and only the centroids themselves pass through the
driver.  All arithmetic is in integers, so the result does not depend on the
partitioning.

Cases: a vector of another length, null, or with a null or non-finite component
is left out; so fewer rows than input rows may come back, and none from an
empty table.  Fewer vectors than centroids give fewer centroids.  Rows that
share a vec_id are separate vectors; as starts they are ordered by their
components, and a null vec_id is hashed as ``-``.  Equal distances go to the
smaller number; a centroid without vectors stays where it is.  A component
whose scaled value needs more than 27 bits is an error, as distances would not
fit 64 bits.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.llm.tables import stored

WIDTH = 2          # dimensions a block
CHUNK = 1 << 15    # vectors a dictionary serves; a code fits two bytes
LIMIT = 1 << 27


def _integers(col: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integers)."""
    size = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(size == dims)
    flat = pc.list_flatten(col.take(pa.array(fits))).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan
    x = flat.reshape(-1, dims)
    good = np.isfinite(x).all(axis=1)
    x = np.floor(x[good] * scale)
    if len(x) and not (np.abs(x) < LIMIT).all():
        raise ValueError("a component is too large for exact distances")
    return fits[good], x.astype(np.int64)


def _encode(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    """One chunk: vec_ids, per block the dictionary's entries, one code per vector and block."""
    entries, codes = [], []
    for at in range(0, x.shape[1], WIDTH):
        part = x[:, at:at + WIDTH]
        kinds, code = np.unique(part, axis=0, return_inverse=True)
        entries.append(kinds.astype("<i4").tobytes())
        codes.append(code.ravel().astype("<u2"))
    return pa.record_batch([
        pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([entries], pa.list_(pa.binary())),
        pa.array([np.concatenate(codes).tobytes()], pa.binary())], names=["ids", "entries", "codes"])


def encode_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """Stored chunks of the vectors that count."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0
        for b in batches:
            for i in range(0, b.num_rows, CHUNK):
                part = b.slice(i, CHUNK)
                kept, x = _integers(part.column("x"), dims, scale)
                if n + len(kept) > CHUNK:
                    yield _encode(pa.concat_arrays(ids), np.concatenate(held))
                    ids, held, n = [], [], 0
                if len(kept):
                    ids.append(part.column("vec_id").take(pa.array(kept)))
                    held.append(x)
                    n += len(kept)
        if n:
            yield _encode(pa.concat_arrays(ids), np.concatenate(held))

    return stored(rows.mapInArrow(pack, "ids array<long>, entries array<binary>, codes binary"), "chunks")


def _chunk(b: pa.RecordBatch, i: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(entries, codes) of the chunk in row ``i``, one of each per block."""
    entries = [np.frombuffer(e, "<i4").astype(np.int64) for e in b.column("entries")[i].as_py()]
    codes = np.frombuffer(b.column("codes")[i].as_buffer(), "<u2").reshape(len(entries), -1)
    return entries, codes


def nearest(entries: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector of a chunk."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for block, (flat, code) in enumerate(zip(entries, codes)):
        part = centroids[:, block * WIDTH:(block + 1) * WIDTH]
        gap = flat.reshape(-1, 1, part.shape[1]) - part[None]
        total += (gap * gap).sum(axis=2)[code]
    at = total.argmin(axis=1)
    return at, total[np.arange(len(at)), at]


def _starts(vectors: DataFrame, chunks: DataFrame, k: int, dims: int) -> np.ndarray:
    """The ``k`` first vectors in the order of their hashes."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids = b.column("ids")[i].as_py()
                name = [hashlib.sha256(b"1:%s" % (b"-" if v is None else b"%d" % v)).hexdigest() for v in ids]
                order = np.argsort(np.array(name), kind="stable")
                # as many as could win, and all that share the last one's hash
                take = [j for j in order.tolist() if name[j] <= name[order[min(k, len(order)) - 1]]]
                entries, codes = _chunk(b, i)
                x = np.concatenate([e.reshape(-1, min(WIDTH, dims - n * WIDTH))[codes[n, take]]
                                    for n, e in enumerate(entries)], axis=1)
                yield pa.record_batch([pa.array([name[j] for j in take]), pa.array(x.tolist(), pa.list_(pa.int64()))],
                                      names=["name", "x"])

    rows = chunks.mapInArrow(unpack, "name string, x array<long>").orderBy("name", "x").limit(k).collect()  # k rows
    return np.array([r["x"] for r in rows], np.int64).reshape(-1, dims)


def _sums(chunks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """cluster -> (vectors, sum of distances, sum of each component), added up in Spark."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, inertia, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                entries, codes = _chunk(b, i)
                at, far = nearest(entries, codes, centroids)
                count += np.bincount(at, minlength=k)
                np.add.at(inertia, at, far)
                for block, (flat, code) in enumerate(zip(entries, codes)):
                    e = flat.reshape(-1, min(WIDTH, dims - block * WIDTH))
                    held = np.bincount(at * len(e) + code, minlength=k * len(e)).reshape(k, -1)
                    total[:, block * WIDTH:block * WIDTH + e.shape[1]] += held @ e
        used = np.flatnonzero(count)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(inertia[used]),
                               pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "far", "total"])

    rows = (chunks.select("entries", "codes").mapInArrow(add, "cluster int, n long, far long, total array<long>")
            .groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("far").alias("far"),
                                    F.array(*(F.sum(F.get("total", F.lit(d))) for d in range(dims))).alias("total")))
    return {r["cluster"]: (r["n"], r["far"], r["total"]) for r in rows.collect()}  # one row per cluster


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` (integers) of each vector that counts."""
    chunks = encode_vectors(vectors, id_col, vector_col, dims, scale)
    centroids = _starts(vectors, chunks, k, dims)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        for c, (n, _far, total) in _sums(chunks, centroids).items():
            centroids[c] = [t // n for t in total]
    far = {c: f for c, (_, f, _total) in _sums(chunks, centroids).items()}
    whole = sum(far.values())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array([far.get(c, 0) for c in range(len(centroids))], np.int64)
        points = pa.array(centroids.tolist(), pa.list_(pa.int64()))
        for b in batches:
            for i in range(b.num_rows):
                ids = b.column("ids").slice(i, 1).flatten()
                entries, codes = _chunk(b, i)
                for j in range(0, len(ids), 4096):
                    at, dist = nearest(entries, codes[:, j:j + 4096], centroids)
                    yield pa.record_batch([ids.slice(j, 4096), pa.array(at.astype(np.int32)), pa.array(dist), pa.array(own[at]),
                                           pa.array(np.full(len(at), whole, np.int64)), points.take(pa.array(at))],
                                          names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"])

    return chunks.mapInArrow(assign, schema)
