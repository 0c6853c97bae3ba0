"""Operator 5: best-fit packing planned over a histogram of lengths.

Only the number of pieces of each length matters to best fit, so the plan is
made over at most ``capacity`` counters: lengths go from long to short, each
into the sequences with the least room that still holds it; equally filled
sequences are one range of the plan.  A piece then takes the planned slot of
its rank within its length.  Ranks come from two levels (rank within the map
task, counts of the tasks before), so a length that a third of all pieces
share is no single task's work.

Cases: null and empty texts are the end id alone; longer documents than
``capacity`` are cut from the end, so that only the first piece may be short;
rows that share a doc_id (also a null one) are packed as separate documents;
an empty table gives an empty result; columns other than the two named ones
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from permscope.llm.tables import stored
from permscope.llm.text import BATCH_BYTES, keyed, ranges, text_batches
from permscope.llm.tokens import crc32s, encode, with_end

CAPACITY = 1024


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, last rank + 1, first sequence, pieces a sequence, offset).

    Pieces ``first .. last`` of the length fill consecutive sequences from
    ``first sequence``, each with the given number of them side by side.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # ranges of sequences by room left
    plan, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        space = length
        while left:
            while space <= capacity and not room[space]:
                space += 1
            if space <= capacity:
                first, n = room[space].pop()
                have = space
            else:
                have = capacity
                first, n = made, -(-left // (capacity // length))
                made += n
            each = have // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - have))
                room[have - each * length].append((first, full))
                rank, left = rank + full * each, left - full * each
                first, n = first + full, n - full
            if left and n:  # fewer pieces than one sequence takes
                plan.append((length, rank, rank + left, first, left, capacity - have))
                room[have - left * length].append((first, 1))
                first, n, left = first + 1, n - 1, 0
            if n:
                room[have].append((first, n))
    return plan


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and the place (task, nth) of each piece among its length."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in text_batches(batches, limit=2 * BATCH_BYTES):  # fewer different chunks a byte
            ids, off = with_end(*encode(b.column("text"), tokenizer), end_id)
            size = np.diff(off)
            number = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), number)
            piece = ranges(np.zeros(len(size), np.int64), number)
            short = size - (number - 1) * capacity
            start = np.where(piece > 0, short[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, short[row])
            crc = np.fromiter(crc32s(ids, off[row] + start, off[row] + start + length), np.int64, len(row))
            at = np.argsort(length, kind="stable")
            nth = np.empty(len(row), np.int64)
            head = np.searchsorted(length[at], length[at])
            nth[at] = np.arange(len(row)) - head + seen[length[at]]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.record_batch([b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                                   pa.array(length), pa.array(crc), pa.array([task] * len(row), pa.int32()), pa.array(nth)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack_best_fit(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    rows = stored(pieces(keyed(docs, id_col, text_col), tokenizer, end_id, capacity), "pieces")
    held = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(best_fit_plan(counts, capacity),
                                 "length long, lo long, hi long, first long, each long, at long")
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = held.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # the plan has a few rows per length, whatever the number of documents
    slot = ranked.join(F.broadcast(plan), "length").where("rank >= lo and rank < hi")
    inside = F.col("rank") - F.col("lo")
    return slot.select("doc_id", "piece", "start", "length", "ids_crc32",
                       (F.col("first") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
                       (F.col("at") + F.pmod(inside, F.col("each")) * F.col("length")).alias("offset"))
