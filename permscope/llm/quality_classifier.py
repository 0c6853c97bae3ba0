"""Operator 4: quality classifier by random Fourier features, ridge scores and isotonic calibration.

Document statistics (``stats.py``) are standardised, mapped by random cosines
that approximate a Gaussian kernel, and scored by ridge regression whose
normal equations are sums over the partitions of the labelled rows (all of
them; nothing is sampled).  Scores are calibrated to probabilities by isotonic
regression over a histogram of fixed size, fitted on another fold than the
weights.  Rows with crc32(doc_id) mod 5 = 0 are held out of both.

Cases: null, empty and wordless texts have the statistics of an empty text and
get its score; labels without doc_id or quality are ignored and rows with
several labels count with each; without labels (or with labels of one value)
every score is the share of label 1, 0.5 if there is none; a null doc_id is
not held out; an empty table gives an empty result; columns other than the two
named ones (lang and source too) are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.llm.quality_rules import labelled, with_statistics
from permscope.llm.stats import FEATURES
from permscope.llm.tables import stored

WIDTH = 384          # random Fourier features
RIDGE = 1e-3         # per labelled row
GAMMA = 0.6          # kernel width in standard deviations, times sqrt(number of statistics)
SEED = 7
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 1
BINS = 1 << 11
THRESHOLD = 0.3


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    value: np.ndarray  # calibrated probability of each score bin

    def score(self, features: np.ndarray) -> np.ndarray:
        return cosines(features, self.mean, self.scale, self.weight, self.phase) @ self.beta

    def probability(self, features: np.ndarray) -> np.ndarray:
        return self.value[score_bin(self.score(features))]


def score_bin(score: np.ndarray) -> np.ndarray:
    """Fixed bins over scores of -0.5 to 1.5."""
    return np.clip(((score + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray, phase: np.ndarray) -> np.ndarray:
    z = np.cos(np.clip((x - mean) / scale, -6, 6) @ weight + phase) * np.sqrt(2 / len(phase))
    return np.column_stack([z, np.ones(len(x))])


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)), F.lit(-1))


def _features(b: pa.RecordBatch) -> np.ndarray:
    return np.asarray(b.column("features").flatten()).reshape(-1, len(FEATURES))


def _summed(rows: DataFrame, size: int, part) -> np.ndarray:
    """Sum over partitions of ``part(batch) -> size numbers``; partial sums meet in a tree."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += part(b)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["total"])

    sums = rows.mapInArrow(add, "total binary").rdd.map(lambda r: np.frombuffer(r[0]))
    return sums.treeReduce(lambda a, b: a + b, depth=3) if sums.getNumPartitions() else np.zeros(size)


def pool(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Isotonic regression (pool adjacent violators) of good/total over ordered bins, filled between bins."""
    blocks: list[list[float]] = []
    at = np.flatnonzero(total)
    for i in at.tolist():
        blocks.append([good[i], total[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, t, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + t, blocks[-1][2] + k]
    level = np.concatenate([np.full(int(k), g / t) for g, t, k in blocks])
    return np.interp(np.arange(len(total)), at, level)


def train(stats: DataFrame, labels: DataFrame, label: str) -> Model:
    """Fit on the labelled rows outside the held-out fold."""
    d = len(FEATURES)
    rng = np.random.default_rng(SEED)
    weight = rng.normal(size=(d, WIDTH)) / (GAMMA * np.sqrt(d))
    phase = rng.uniform(0, 2 * np.pi, WIDTH)
    rows = labelled(stats, labels, label).withColumn("fold", fold(F.col("doc_id"))).where(f"fold != {HELD_OUT}").select(
        "features", "y", "fold")
    rows = stored(rows, "labelled")

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = _features(b)
        return np.concatenate([[len(x), b.column("y").to_numpy().sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    total = _summed(rows, 2 + 2 * d, moments)
    n = total[0]
    share = total[1] / n if n else 0.5
    mean = total[2:2 + d] / max(n, 1)
    scale = np.sqrt(np.maximum(total[2 + d:] / max(n, 1) - mean**2, 0)) + 1e-6
    model = Model(mean, scale, weight, phase, np.zeros(WIDTH + 1), np.full(BINS, share))
    if not 0 < share < 1:
        return model
    k = WIDTH + 1

    def normal(b: pa.RecordBatch) -> np.ndarray:
        z = cosines(_features(b), mean, scale, weight, phase)
        return np.concatenate([(z.T @ z).ravel(), z.T @ b.column("y").to_numpy().astype(float), [len(z)]])

    total = _summed(rows.where(f"fold != {CALIBRATE}"), k * k + k + 1, normal)
    gram = total[:k * k].reshape(k, k) + RIDGE * max(total[-1], 1) * np.diag(np.append(np.ones(WIDTH), 1e-6)) / WIDTH
    model.beta = np.linalg.solve(gram + 1e-9 * np.eye(k), total[k * k:-1])

    def histogram(b: pa.RecordBatch) -> np.ndarray:
        at = score_bin(model.score(_features(b)))
        y = b.column("y").to_numpy()
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    seen = _summed(rows.where(f"fold = {CALIBRATE}"), 2 * BINS, histogram)
    if seen[:BINS].sum():
        model.value = pool(seen[:BINS], seen[BINS:])
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every input row."""
    stats = stored(with_statistics(docs, id_col, text_col).select("doc_id", "fp", "n_words", "features"), "statistics")
    model = train(stats, labels, label)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array(model.probability(_features(b)))], names=["doc_id", "score"])

    scored = stats.select("doc_id", "features").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
