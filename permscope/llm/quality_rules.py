"""Operator 9: quality rules and an isolation forest on their statistics.

Base rules look at counts of the whole text; documents that pass them are
judged by an isolation forest over ratios of the same statistics.  The forest
is fitted on a bounded sample of rows labelled good (``SAMPLE``, the smallest
hashes).  A split is drawn from the rows' range in a node widened by ``MARGIN``
standard deviations, so that documents outside the range of good ones end
alone, on short paths.  The score threshold is calibrated on ALL labelled rows (a histogram of fixed size): the
lowest one that rejects at most ``GOOD_LOSS`` of the good rows.

Cases: null text has no words and fails the base rules, as does an empty one;
without rows labelled good nothing but the base rules rejects; labels without
doc_id or quality are ignored; each row is judged on its own text, so repeated
doc_ids are no matter; a null doc_id is judged like any other; an empty table
gives an empty result; columns other than the two named ones are ignored by
``judge`` and passed on untouched by ``keep_good``, whatever their names.  A
long text is measured whole, in arrays of some ten times its size in its task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from permscope.llm.stats import BASE, FEATURES, STATISTICS_BYTES, statistics
from permscope.llm.tables import stored
from permscope.llm.text import keyed, text_batches

TREES, PSI = 100, 256
SAMPLE = TREES * PSI      # rows labelled good that the forest sees at most
SEED = 20240229
BINS = 1 << 12
GOOD_LOSS = 0.001
MARGIN, LEAST = 3.0, 0.02  # standard deviations; least width of a ratio
RULES = ["symbols", "upper", "marks", "bang", "pipes", "odd_words", "short_words", "sentence_marks", "digits", "word_length"]
_COLUMNS = [FEATURES.index(k) for k in RULES]
MIN_WORDS, MAX_REPEAT = 20, 30


@dataclass
class Forest:
    """Trees in heap order: child of node i are 2i + 1 and 2i + 2; a leaf has feature -1."""

    feature: np.ndarray
    split: np.ndarray
    length: np.ndarray
    psi: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 for unusual rows."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, length in zip(self.feature, self.split, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(math.log2(len(feature) + 1)) - 1):
                f = feature[node]
                node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] >= split[node]))
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / max(expected(self.psi), 1e-9))


def expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def fit_forest(x: np.ndarray, trees: int = TREES, psi: int = PSI, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    psi = min(psi, len(x))
    depth = max(1, math.ceil(math.log2(max(psi, 2))))
    nodes = 2 ** (depth + 1) - 1
    widen = np.maximum(MARGIN * x.std(axis=0), LEAST)
    feature, split, length = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), psi, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            if level == depth or len(rows) < 2:
                length[t, node] = level + expected(len(rows))
                continue
            f = int(rng.integers(x.shape[1]))
            lo, hi = rows[:, f].min() - widen[f], rows[:, f].max() + widen[f]
            feature[t, node], split[t, node] = f, rng.uniform(lo, hi)
            right = rows[:, f] >= split[t, node]
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(feature, split, length, psi)


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fp, <base counts>, features`` of every input row."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, limit=STATISTICS_BYTES):
            base, features = statistics(b.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(features.ravel()), features.shape[1])
            yield pa.record_batch([b.column("doc_id"), b.column("fp"), *(pa.array(c) for c in base.T),
                                   flat.cast(pa.list_(pa.float64()))], names=["doc_id", "fp", *BASE, "features"])

    return keyed(docs, id_col, text_col).mapInArrow(
        measure, "doc_id long, fp int, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>")


def labelled(stats: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Rows of ``stats`` with each of their labels as ``y`` (0 or 1)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    return stats.join(known.where("doc_id is not null and y is not null"), "doc_id")


def good_sample(stats: DataFrame, labels: DataFrame, label: str, size: int) -> np.ndarray:
    """Statistics of at most ``size`` rows labelled 1 that pass the base rules, those with the smallest hashes."""
    good = labelled(stats, labels, label).where("y = 1 and not base_failed")
    rank = F.xxhash64("doc_id", "fp", F.lit(SEED)).bitwiseAND(F.lit((1 << 31) - 1))
    # a cut on the hash first: tasks send the driver little more than the sample, however many they are
    limit = int(min(1.0, 1.1 * size / max(good.count(), 1)) * (1 << 31))
    rows = good.where(rank < limit).orderBy(rank, "doc_id", "fp").limit(size).select("features").collect()
    return np.array([r["features"] for r in rows]).reshape(-1, len(FEATURES))[:, _COLUMNS]


def score_column(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with ``anomaly`` (0 without a forest)."""
    schema = StructType([*stats.schema.fields, StructField("anomaly", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column("features").flatten()).reshape(-1, len(FEATURES))[:, _COLUMNS]
            s = forest.score(x) if forest is not None else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=schema.names)

    return stats.mapInArrow(score, schema)


def calibrate(scored: DataFrame, labels: DataFrame, label: str, loss: float = GOOD_LOSS) -> float:
    """The lowest threshold that rejects at most ``loss`` of the good rows that pass the base rules."""
    at = F.floor(F.col("anomaly") * BINS).cast("int")
    rows = labelled(scored.where("not base_failed"), labels, label).where("y = 1").groupBy(at.alias("at")).agg(
        F.count("*").alias("n")).collect()  # at most BINS rows
    count = np.zeros(BINS + 2, np.int64)
    for r in rows:
        count[r["at"]] += r["n"]
    above = count[::-1].cumsum()[::-1]  # good rows in this bin or a higher one
    if not above[0]:
        return 2.0
    allowed = np.flatnonzero(above <= loss * above[0])
    return float(allowed[0]) / BINS


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label: str = "quality", keep_row: bool = False) -> DataFrame:
    """``doc_id, fp, <base counts>, base_failed, anomaly, kept`` (and ``row``) of every input row; ``fp`` hashes its text."""
    stats = stored(with_statistics(docs, id_col, text_col), "statistics").withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"))
    slim = stats.select("doc_id", "fp", "n_words", "base_failed", "features")
    sample = good_sample(slim, labels, label, SAMPLE)
    forest = fit_forest(sample) if len(sample) else None
    limit = calibrate(score_column(slim, forest), labels, label) if forest is not None else 2.0
    out = score_column(stats, forest).withColumn("kept", F.expr(f"not base_failed and anomaly < {limit!r}D"))
    if not keep_row:
        return out
    rows, same = _by_text(docs, id_col, text_col)
    out = out.dropDuplicates(["doc_id", "fp"])
    return rows.join(out, same).drop("row_id", "row_fp")


def _by_text(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    """(``row_id, row_fp, row`` of each row, the condition that it is the row ``doc_id, fp``): equal texts, equal verdicts."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = keyed(docs, id_col, text_col, whole).drop("text").withColumnsRenamed({"doc_id": "row_id", "fp": "row_fp"})
    return rows, F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_fp") == F.col("fp"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, as they are: only numbers go through Python a second time."""
    gone = judge(docs, labels, id_col, text_col, label).where("not kept").select("doc_id", "fp").distinct()
    rows, same = _by_text(docs, id_col, text_col)
    return rows.join(stored(gone, "rejected"), same, "left_anti").select("row.*")
