"""Operator 3: token ids in frequency-ranked, byte-aligned variable-length files.

Ids are replaced by their rank in the corpus (0 = most frequent), so most take
one byte.  A rank takes 1 to 4 little-endian bytes; the lengths of four ranks
are two bits each of one control byte, and control bytes lie apart from the
data bytes.  Decoding looks the four lengths up in a 256-row table and gathers.

A file holds the documents of one range of doc_ids in ascending order (a null
doc_id comes first, rows that share a doc_id are ordered by their text's hash):

    8 bytes  b"RANKVB1\\n"
    4 x u64  documents, ids, control bytes, data bytes
    i64 doc_id, u8 has doc_id, u32 ids of each document; control bytes; data bytes

``ranks.u32`` beside the files gives the id of each rank.  Documents are
encoded once, into a table of compressed blocks by range of doc_ids; each task
adds a row with its counts of ids, which Spark sums to the ranks.  Then the
blocks are shuffled and each range is written as files of at most ``FILE_IDS``
ids (or one document).  Ranges are cut at quantiles of doc_id, as many as the
size of the input asks for; a doc_id that fills several ranges (also a null
one) is dealt among them by its texts' hashes.

Cases: null and empty texts have the end id alone; a long text is encoded in
one piece and its ids take four bytes each in its task; rows that share a
doc_id are ordered by their text's hash, equal rows are neighbours; an empty
table gives no file and no row; columns other than the two named ones are
ignored, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from permscope.llm.blobs import BLOB_SCHEMA, blob_rows, unpack_blobs
from permscope.llm.tables import get_file, put_file, shards_for, stored
from permscope.llm.text import BATCH_BYTES, keyed, text_batches
from permscope.llm.tokens import encode, load, with_end

FILE_IDS = 1 << 25
RANGE_BYTES = 32 << 20   # input bytes a range of doc_ids has on average, at most
COUNTS = -1              # shard of the rows that hold a task's counts
_NULL = -(1 << 62)       # stands for a null doc_id: it comes first
MAGIC = b"RANKVB1\n"
_LENGTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)


def pack_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[:len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control, data


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = _LENGTHS[control].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    padded = np.append(data, np.zeros(3, np.uint8))
    out = padded[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] |= padded[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _shard(doc: np.ndarray, fp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Range of each row; a doc_id that stands several times in ``bounds`` has several ranges."""
    low = np.searchsorted(bounds, doc, side="left")
    more = np.searchsorted(bounds, doc, side="right") - low
    return (low + (fp.astype(np.int64) * (more + 1) >> 31)).astype(np.int32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", files: int | None = None) -> DataFrame:
    """Write ``docs`` as token files under ``path``; returns the manifest (file, documents, ids)."""
    spark = docs.sparkSession
    n = files or 2 * shards_for(docs, 2 * RANGE_BYTES)
    docs = keyed(docs, id_col, text_col)
    place = docs.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id"))
    # n numbers; they only balance the ranges
    bounds = np.array(place.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n), np.float64)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(max(load(tokenizer).get_vocab_size(), end_id + 1), np.int64)
        small = len(total) <= 1 << 16
        for b in text_batches(batches, limit=2 * BATCH_BYTES):  # fewer different chunks a byte
            ids, off = with_end(*encode(b.column("text"), tokenizer), end_id)
            more = np.bincount(ids)
            if len(more) > len(total):
                total = np.append(total, np.zeros(len(more) - len(total), np.int64))
            total[:len(more)] += more
            doc = b.column("doc_id")
            rows = pa.table({"doc_id": doc, "fp": b.column("fp"), "ids": pa.LargeListArray.from_arrays(
                pa.array(off), pa.array(ids.astype(np.uint16) if small else ids))})
            yield blob_rows(rows, _shard(doc.fill_null(_NULL).to_numpy(), b.column("fp").to_numpy(), bounds))
        if total.any():
            used = np.flatnonzero(total)
            yield blob_rows(pa.table({"id": used, "n": total[used]}), np.full(len(used), COUNTS, np.int32))

    blobs = stored(docs.mapInArrow(tokens, BLOB_SCHEMA), "blocks")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("blob").to_pylist():
                yield from pa.ipc.open_stream(x)

    held = (blobs.where(F.col("shard") == COUNTS).mapInArrow(counts, "id long, n long").groupBy("id")
            .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").select("id").collect())  # ids of the vocabulary
    order = np.array([r["id"] for r in held], "<u4")
    if not len(order):
        return spark.createDataFrame([], "file long, documents long, ids long")
    rank = np.zeros(int(order.max()) + 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    put_file(f"{path}/ranks.u32", order.tobytes())
    ranks = spark.sparkContext.broadcast(rank)  # one number per id of the vocabulary

    def write(part: pa.Table) -> pa.Table:
        shard = part.column("shard")[0].as_py()
        rows = unpack_blobs(part)
        rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("fp", "ascending")],
                                                 null_placement="at_start")).combine_chunks()
        last = np.cumsum(pa.compute.list_value_length(rows.column("ids")).to_numpy())
        made, i = [], 0
        while i < rows.num_rows:
            j = max(i + 1, int(np.searchsorted(last, (last[i - 1] if i else 0) + FILE_IDS, side="right")))
            file = (shard << 24) + len(made)
            made.append((file, j - i, _write_file(f"{path}/{file:016d}.rvb", rows.slice(i, j - i), ranks.value)))
            i = j
        return pa.table(dict(zip(["file", "documents", "ids"], (pa.array(c, pa.int64()) for c in zip(*made)))))

    done = blobs.where(F.col("shard") != COUNTS).groupBy("shard").applyInArrow(write, "file long, documents long, ids long")
    return stored(done, "manifest")


def _write_file(name: str, rows: pa.Table, rank: np.ndarray) -> int:
    """Writes one file; returns its number of ids."""
    rows = rows.combine_chunks()
    doc, ids = rows.column("doc_id").combine_chunks(), rows.column("ids").combine_chunks()
    size = pa.compute.list_value_length(ids).to_numpy().astype("<u4")
    flat = rank[ids.flatten().to_numpy()]
    control, data = pack_ranks(flat)
    head = MAGIC + struct.pack("<4Q", rows.num_rows, len(flat), len(control), len(data))
    known = doc.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    put_file(name, b"".join([head, doc.fill_null(0).to_numpy().astype("<i8").tobytes(), known.tobytes(), size.tobytes(),
                         control.tobytes(), data.tobytes()]))
    return len(flat)


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before, over all files.
    """
    by = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    begin = manifest.select("file", F.coalesce(F.sum("ids").over(by), F.lit(0)).alias("begin"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.frombuffer(get_file(f"{path}/ranks.u32"), "<u4")
        for b in batches:
            for file, raw in zip(b.column("file").to_pylist(), b.column("content")):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                if raw[:8].tobytes() != MAGIC:
                    raise ValueError(f"not a token file: {file}")
                docs, n, n_control, n_data = struct.unpack("<4Q", raw[8:40].tobytes())
                at = 40

                def take(count, dtype):
                    nonlocal at
                    size = count * np.dtype(dtype).itemsize
                    at += size
                    return np.frombuffer(raw[at - size:at].tobytes(), dtype)

                doc, known, size = take(docs, "<i8"), take(docs, np.uint8), take(docs, "<u4").astype(np.int64)
                ids = order[unpack_ranks(take(n_control, np.uint8), take(n_data, np.uint8), n)]
                last = np.cumsum(size)
                raw_ids = ids.astype("<u4").tobytes()
                step = max(1, len(doc) // max(1, len(raw_ids) >> 23))
                for i in range(0, docs, step):
                    j = min(i + step, docs)
                    lo, hi = last[i:j] - size[i:j], last[i:j]
                    yield pa.record_batch([
                        pa.array([file] * (j - i), pa.int64()), pa.array(doc[i:j], mask=known[i:j] == 0),
                        pa.array(lo), pa.array(size[i:j]),
                        pa.array([raw_ids[4 * x:4 * y] for x, y in zip(lo.tolist(), hi.tolist())], pa.binary())],
                        names=["file", "doc_id", "at", "n_tokens", "ids"])

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.rvb").load(path)
             .select(F.regexp_extract("path", r"(\d+)\.rvb$", 1).cast("long").alias("file"), "content"))
    # the manifest has three numbers a file: Spark broadcasts it while it is small
    rows = files.mapInArrow(decode, "file long, doc_id long, at long, n_tokens long, ids binary")
    return rows.join(begin, "file").select("doc_id", (F.col("begin") + F.col("at")).alias("start"),
                                                        "n_tokens", "ids")
