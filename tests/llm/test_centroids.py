import math
import random

import numpy as np
import pytest
from brute import sha256

from permscope.llm import centroids
from permscope.llm.centroids import cluster_vectors


def plain(rows, k, rounds, dims, scale):
    kept = [(i, tuple(math.floor(float(np.float32(x)) * scale) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((sha256(f"1:{'-' if i is None else i}"), v) for i, v in kept)[:k]
    points = [list(v) for _, v in start]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, p)) for p in points]
            out.append((i, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(points)):
            mine = [v for _, v, at, _ in now if at == c]
            if mine:
                points[c] = [sum(x) // len(mine) for x in zip(*mine)]
    now = assign()
    far = {c: sum(d for _, _, at, d in now if at == c) for c in range(len(points))}
    return sorted((i is not None, i or 0, c, d, far[c], sum(far.values()), tuple(points[c])) for i, _, c, d in now)


def answer(df):
    return sorted((r.vec_id is not None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid))
                  for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int, x string, cluster string"


def odd_vectors(n, dims, seed=3):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1.5, -0.25, 0.0, 0.1, 0.7, 2.0]) for _ in range(dims)]) for k in range(n)]
    rows += [(1000, rows[0][1])] * 30                                    # a third of all rows alike
    rows += [(k, rows[1][1]) for k in (5, 5, None, None)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * (dims - 1)), (2003, [0.0] * (dims + 1)), (2004, [float("nan")] * dims),
             (2005, [float("inf")] + [0.0] * (dims - 1)), (2006, [None] + [0.0] * (dims - 1))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("dims,k,chunk", [(4, 5, 1 << 15), (5, 16, 7), (1, 3, 16)])
def test_equals_plain_rounds(spark, monkeypatch, dims, k, chunk):
    monkeypatch.setattr(centroids, "CHUNK", chunk)
    rows = odd_vectors(60, dims)
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(5)
    assert answer(cluster_vectors(df, k, 3, dims, 64)) == plain(rows, k, 3, dims, 64)


def test_few_vectors_and_none(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]):
        df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
        assert answer(cluster_vectors(df, 16, 3, 2, 64)) == plain(rows, 16, 3, 2, 64)


def test_partitioning_does_not_matter(spark):
    rows = odd_vectors(300, 8, seed=9)
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    assert answer(cluster_vectors(df.repartition(1), 6, 4, 8, 10)) == answer(cluster_vectors(df.repartition(11), 6, 4, 8, 10))
