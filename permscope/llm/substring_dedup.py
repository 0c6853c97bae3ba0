"""Operator 1: substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller doc_id;
windows are judged on the input.  Super-k-mers (``superkmers.py``) bring equal
windows to one bucket, where they are sorted and the smallest document of
each distinct window is found; equal hashes are compared word by word, so the
result is exact.

Cases: null text has no words; fewer than ``window`` words are kept whole; a
null doc_id is neither smaller nor larger than any other, so its row is kept
whole and is no source; rows that share a doc_id are no source for one
another; an empty table gives an empty result; columns other than the two
named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.llm import superkmers as sk
from permscope.llm.blobs import BLOB_SCHEMA, shard_table
from permscope.llm.text import column_words, covered, keyed, mix, packed_words, rolling, word_hashes

WINDOW = 13
MINIMISER = 3


def word_units(col: pa.Array) -> sk.Units:
    w = column_words(col)
    return sk.Units(w.buf, w.off, w.doc, word_hashes(w), len(w))


def equal_windows(ids: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): windows ``ids[at[i]:at[i]+window]`` sorted so that equal ones share a group."""
    h = mix(rolling(mix(ids.astype(np.uint64) + np.uint64(0x9E3779B9)), window)[at])
    order = np.argsort(h)
    p, hs = at[order], h[order]
    same = np.zeros(len(p), bool)
    pair = np.flatnonzero(hs[1:] == hs[:-1])
    equal = np.ones(len(pair), bool)
    for j in range(window):
        equal &= ids[p[pair] + j] == ids[p[pair + 1] + j]
    same[pair + 1] = True
    group = np.cumsum(~same) - 1
    if not equal.all():  # different windows with one hash: tell them apart by content
        bad = np.flatnonzero(np.isin(group, group[pair[~equal] + 1]))
        rows = ids[p[bad][:, None] + np.arange(window)]
        _, exact = np.unique(np.column_stack([group[bad], rows]), axis=0, return_inverse=True)
        group[bad] = len(p) + exact.ravel()
        _, group = np.unique(group, return_inverse=True)
        again = np.argsort(group, kind="stable")
        order, group = order[again], group[again]
    return order, group


def repeated(window: int, shards: int):
    """Bucket function: blobs of the spans of words whose window starts in a smaller document."""
    def find(table: pa.Table) -> pa.Table:
        meta, data, lo = sk.unpack(table)
        done = meta["len"] < 0
        out = [(meta["doc"][done], meta["fp"][done], meta["start"][done].astype(np.int64),
                meta["start"][done].astype(np.int64) - meta["len"][done] + window - 1)]
        live = meta[~done]
        if len(live):
            w = packed_words(data, np.append(lo[~done], len(data)))
            ids, _ = w.ids()
            count = np.diff(w.doc) - window + 1
            at = np.repeat(w.doc[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            rec = np.repeat(np.arange(len(live)), count)
            order, group = equal_windows(ids, at, window)
            doc = live["doc"][rec[order]]
            low = np.minimum.reduceat(doc, np.flatnonzero(np.append(True, np.diff(group) != 0)))
            hit = order[doc > low[group]]
            r = rec[hit]
            s = live["start"][r] + (at[hit] - w.doc[:-1][r])
            out.append((live["doc"][r], live["fp"][r], s, s + window))
        return pa.Table.from_batches([shard_table(sk.spans_table(*(np.concatenate(x) for x in zip(*out))), shards)])

    return find


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   buckets: int | None = None) -> DataFrame:
    """Blobs (``blobs.py``) of ``doc_id, fp, s, e``: spans of words that repeat a smaller document.

    Spans of one row that come from different buckets may overlap.
    ``blobs.rows_of(.., superkmers.SPAN_SCHEMA)`` gives them as rows.
    """
    n = buckets or sk.default_buckets(docs.sparkSession)
    packed = sk.exchange(keyed(docs, id_col, text_col), word_units, window, MINIMISER, n, within=False)
    return packed.groupBy("bucket").applyInArrow(repeated(window, n), BLOB_SCHEMA)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     buckets: int | None = None) -> DataFrame:
    """``row, n_words, n_removed, kept_text`` for every input row.

    ``row`` is a struct of all input columns; ``kept_text`` has the kept words
    joined by one space.
    """
    n = buckets or sk.default_buckets(docs.sparkSession)
    every = keyed(docs, id_col, text_col, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))

    def cut(b: pa.RecordBatch, base: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.RecordBatch:
        w = column_words(b.column("text"))
        drop = covered(len(w), w.doc[base] + s, w.doc[base] + e)
        size = np.where(drop, 0, np.diff(w.off))
        buf = w.buf[np.repeat(~drop, np.diff(w.off))].tobytes()
        ends = np.append(0, np.cumsum(size))[w.doc]
        kept = [buf[i:max(i, j - 1)] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        gone = np.append(0, np.cumsum(drop))[w.doc]
        return pa.record_batch([b.column("row"), pa.array(np.diff(w.doc), pa.int64()), pa.array(np.diff(gone), pa.int64()),
                                pa.array(kept, pa.binary()).cast(pa.string())],
                               names=["row", "n_words", "n_removed", "kept_text"])

    schema = f"row {every.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_text string"
    return sk.apply_spans(every, repeated_spans(docs, id_col, text_col, window, n), cut, schema, n)
