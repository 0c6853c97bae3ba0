"""Whole texts as numpy arrays of units, one Arrow batch at a time.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``.  Those
separators are ASCII, so splitting UTF-8 bytes equals splitting the text.  A
null text has no words and no bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def row_key(text: Column) -> Column:
    """32 bits of the text's hash: tells rows apart that share a doc_id."""
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc_id, fp, text`` of each row, whatever other columns ``docs`` has."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), row_key(text).alias("fp"),
                       text.alias("text"), *more)


def release() -> None:
    """Give freed memory back to the system: workers are used again, and idle ones would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text",
                 limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
                         .astype(np.int64))
        i = 0
        while i < b.num_rows:
            done = size[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield b.slice(i, j - i)
            i = j
    release()


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null row is empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


@dataclass
class Words:
    """Words of a batch: ``buf`` has each word followed by one space."""

    buf: np.ndarray    # uint8
    off: np.ndarray    # start of each word in buf, and len(buf)
    doc: np.ndarray    # first word of each row, and the number of words
    begin: np.ndarray  # start of each word in the raw bytes

    def __len__(self) -> int:
        return len(self.off) - 1

    def array(self) -> pa.LargeBinaryArray:
        """The words (each with its closing space) as an Arrow array, not copied."""
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(self.off), pa.py_buffer(self.buf)])

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """(id of each word within the batch, the distinct words): exact, no hashing."""
        d = self.array().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary

    def lengths(self) -> np.ndarray:
        return np.diff(self.off) - 1


def words_of(data: np.ndarray, off: np.ndarray) -> Words:
    sep = _SEPARATOR[data]
    head = ~sep
    tail = ~sep
    n = len(data)
    if n:
        cut = off[:-1][off[:-1] < n]
        before = np.empty(n, bool)
        before[0], before[1:] = True, sep[:-1]
        before[cut] = True
        head &= before
        after = np.empty(n, bool)
        after[-1], after[:-1] = True, sep[1:]
        ends = off[1:][off[1:] > 0]
        after[ends - 1] = True
        tail &= after
    begin = np.flatnonzero(head)
    size = np.flatnonzero(tail) + 1 - begin
    woff = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(size + 1, out=woff[1:])
    buf = np.full(int(woff[-1]), 0x20, np.uint8)
    inside = np.ones(len(buf), bool)
    inside[woff[1:] - 1] = False
    buf[inside] = data[~sep]
    return Words(buf, woff, np.searchsorted(begin, off), begin)


def packed_words(data: np.ndarray, off: np.ndarray) -> Words:
    """Words of strings that already have each word followed by one space (light on memory)."""
    woff = np.append(0, np.flatnonzero(data == 0x20) + 1)
    return Words(data, woff, np.searchsorted(woff, off), woff[:-1])


def column_words(col: pa.Array) -> Words:
    return words_of(*raw_bytes(col))


_BASE = 0x9E3779B97F4A7C15
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(w: Words) -> np.ndarray:
    """64-bit content hash of each word, eight bytes at a time (for routing; equality is checked on words)."""
    padded = np.append(w.buf, np.zeros(8, np.uint8))
    eight = np.ndarray((len(w.buf) + 1,), "<u8", padded, 0, (1,))
    size = w.lengths()
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    todo, done = np.arange(len(w)), 0
    while len(todo):
        left = size[todo] - done
        out[todo] = mix(out[todo] ^ (eight[w.off[todo] + done] & _FIRST_BYTES[np.minimum(left, 8)]))
        done += 8
        todo = todo[left > 8]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTE_CODE[data]


def rolling(unit: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every ``width`` consecutive units, by doubling."""
    base = _BASE
    out, done, power, size = None, 0, unit, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out, done = power, size
            else:  # power covers the units before out
                n = len(out) - size
                if n <= 0:
                    return np.zeros(0, np.uint64)
                out = power[:n] * np.uint64(pow(base, done, 1 << 64)) + out[size:size + n]
                done += size
        left >>= 1
        if left:
            n = len(power) - size
            if n <= 0:
                return np.zeros(0, np.uint64)
            power = power[:n] * np.uint64(pow(base, size, 1 << 64)) + power[size:size + n]
            size *= 2
    return out


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[0] .. first[0]+count[0]-1, first[1] ..`` as one array."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - (np.cumsum(count) - count), count)
    return shift + np.arange(total)


def covered(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Boolean array of ``n`` units, true inside any of ``[first, last)``."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, first, 1)
    np.add.at(depth, last, -1)
    return np.cumsum(depth[:-1]) > 0
