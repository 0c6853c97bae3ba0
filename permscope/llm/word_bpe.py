"""Operator 11: byte-level BPE by a global shuffle of distinct words.

1. Texts are split into pre-tokens.  A chunk of texts keeps a list of its
   distinct pre-tokens and, for every position, which of them stands there
   (frequent ones have small numbers, so the compressed list is short).
2. The distinct words of all chunks go to the shard of their hash.  There equal
   words of all chunks meet, and each distinct word is encoded once by the
   merge ranks.
3. The ids travel back to the chunks that asked, one file per chunk in the shared
   folder, and every text is reassembled by position where its chunk is read; so
   positions, the largest part, are written once and never shuffled.

Decoding joins ids to the table of token bytes, whose size is fixed by the
vocabulary, and concatenates the bytes of a text in order.

A word that a third of all positions hold travels once per chunk, not once per
position.  A chunk has about ``CHUNK_BYTES`` of text, one text at least; long
texts are split in pieces of ``PIECE_BYTES`` at white space, so that only their
positions (four bytes each), not the working arrays, grow with them.

Cases: null and empty texts have no ids and decode to no bytes; rows that share
a doc_id, equal rows and null doc_ids are separate rows and all come back; an
empty table gives an empty result; columns other than the two named ones are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from permscope.llm.tables import get_file, put_file, scratch_path, shards_for, stored
from permscope.llm.text import Words, keyed, mix, ranges, raw_bytes, release, text_batches, word_hashes
from permscope.llm.tokens import cuts

CHUNK_BYTES = 24 << 20
PIECE_BYTES = 2 << 20

# Characters of Unicode's White_Space property, which is what \s means in the pattern
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def pre_token_pattern(pattern: str) -> regex.Pattern:
    """``pattern`` with \\s and \\S as Unicode's White_Space (the regex library also counts some controls)."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == "\\s":
            out.append(WHITE if inside else f"[{WHITE}]")
        elif two == "\\S" and not inside:
            out.append(f"[^{WHITE}]")
        elif two[0] == "\\":
            out.append(two)
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            i -= 1
        i += 2
    return regex.compile("".join(out))


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a file with a base64 token and its rank in each line."""
    import base64

    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines.splitlines() if x)}


@functools.lru_cache(maxsize=2)
def _encoder(lines: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(lines), special_tokens={})


@functools.lru_cache(maxsize=2)
def _token_table(lines: bytes) -> pa.Array:
    """Bytes of each id (ids without a token have none)."""
    ranks = read_ranks(lines)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    return pa.array(table, pa.large_binary())


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text's bytes in pieces of about PIECE_BYTES that end where no pre-token goes on."""
    at, step = 0, 1 << 16
    while len(data) - at > PIECE_BYTES:
        end = at + PIECE_BYTES
        while end < len(data):
            look = data[end - 4:end + step]  # three bytes before a stretch decide whether it starts there
            found = cuts(look, np.array([0, len(look)]))
            found = found[found >= 4]
            if len(found):
                end += int(found[0]) - 4
                break
            end += step - 4
        yield data[at:end]
        at = min(end, len(data))
    if at < len(data):
        yield data[at:]


_PLAIN = re.compile(rb" ?[A-Za-z]+").fullmatch


class _Chunk:
    """Rows, distinct words and positions of some texts."""

    def __init__(self, pattern: regex.Pattern):
        self.pattern, self.size = pattern, 0
        self.rows: list[pa.RecordBatch] = []
        self.places: list[np.ndarray] = []   # word of each position
        self.words: dict[bytes, int] = {}
        # where ASCII letters after a space at most are one match, most stretches need no look at the pattern
        self.plain = all(pattern.findall(x) == [x] for x in ("a", "A", " a", " A", " aB", "Ab", " abA"))

    def _words_of(self, stretch: bytes) -> list[int]:
        words = self.words
        if self.plain and _PLAIN(stretch):
            return [words.setdefault(stretch, len(words))]
        return [words.setdefault(w.encode(), len(words)) for w in self.pattern.findall(stretch.decode())]

    def add(self, b: pa.RecordBatch) -> None:
        """Rows of one batch of ``text_batches``: together short, or a single one."""
        data, off = raw_bytes(b.column("text"))
        count = np.zeros(b.num_rows, np.int64)
        for part in _pieces(data):
            begin = cuts(part, off if len(part) == len(data) else np.array([0, len(part)]), marks=True)
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [
                None, pa.py_buffer(np.append(begin, len(part)).astype(np.int64)),
                pa.py_buffer(np.ascontiguousarray(part))]).dictionary_encode()
            held = [self._words_of(s) for s in coded.dictionary.to_pylist()]
            size = np.fromiter(map(len, held), np.int64, len(held))
            flat = np.fromiter(itertools.chain.from_iterable(held), np.uint32, int(size.sum()))
            which = coded.indices.to_numpy(zero_copy_only=False)
            first = np.cumsum(size) - size
            self.places.append(flat[ranges(first[which], size[which])])
            row = np.searchsorted(off, begin, side="right") - 1 if len(part) == len(data) else np.zeros(len(begin), int)
            count += np.bincount(row, size[which], minlength=b.num_rows).astype(np.int64)
        self.rows.append(pa.record_batch([b.column("doc_id"), b.column("fp"), pa.array(count)], names=["doc_id", "fp", "n"]))
        self.size += len(data)

    def stored_rows(self, chunk: int, shards: int) -> Iterator[pa.RecordBatch]:
        """The chunk's row (shard -1: its rows, its positions), and its words by shard."""
        place = np.concatenate(self.places) if self.places else np.zeros(0, np.uint32)
        # frequent words get small numbers: the high bytes of positions are nearly all zero and compress away
        number = np.empty(len(self.words), np.uint32)
        number[np.argsort(-np.bincount(place, minlength=len(self.words)), kind="stable")] = np.arange(len(number))
        place = number[place]
        planes = [_squeeze((place >> np.uint32(8 * k)).astype(np.uint8)) for k in range(4)]
        yield _row(chunk, -1, _ipc(pa.Table.from_batches(self.rows)), planes)
        words = pa.table({"word": pa.array(list(self.words), pa.large_binary()), "number": pa.array(number)})
        if not words.num_rows:
            return
        words = words.sort_by("word").combine_chunks()
        shard = _word_shard(words.column("word").combine_chunks(), shards)
        order = np.argsort(shard, kind="stable")
        words, shard = words.take(pa.array(order)), shard[order]
        cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist() + [len(shard)]
        for i, j in zip(cut[:-1], cut[1:]):
            yield _row(chunk, int(shard[i]), _ipc(words.slice(i, j - i)), None)


_STORED = "chunk long, shard int, blob binary, places array<binary>"


def _row(chunk: int, shard: int, blob: bytes, places: list[bytes] | None) -> pa.RecordBatch:
    return pa.record_batch([pa.array([chunk]), pa.array([shard], pa.int32()), pa.array([blob], pa.binary()),
                            pa.array([places], pa.list_(pa.binary()))], names=["chunk", "shard", "blob", "places"])


def _word_shard(words: pa.LargeBinaryArray, shards: int) -> np.ndarray:
    """Shard of each word by its bytes."""
    off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    spaced = Words(np.insert(data, off[1:], np.uint8(0x20)), off + np.arange(len(off)), np.zeros(1, np.int64), off[:-1])
    return (mix(word_hashes(spaced)) % np.uint64(shards)).astype(np.int64)


def _squeeze(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def _expand(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def _vocabulary(df: DataFrame, ranks: str):
    """The rank file as a broadcast: as large as the vocabulary, whatever the data."""
    with open(ranks, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_texts(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 decoded: bool = False) -> DataFrame:
    """``doc_id, fp, ids`` (and ``decoded``) of each row; ids as little-endian unsigned 32-bit integers.

    ``ranks``: path of a file with base64 tokens and ranks; ``fp`` is 31 bits of
    the text's hash.
    """
    spark = docs.sparkSession
    vocabulary = _vocabulary(docs, ranks)
    shards = shards_for(docs, 128 << 20)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, task, n = pre_token_pattern(pattern), TaskContext.get().partitionId(), 0
        chunk = _Chunk(compiled)
        for b in text_batches(batches, limit=PIECE_BYTES):
            chunk.add(b)
            if chunk.size >= CHUNK_BYTES:
                yield from chunk.stored_rows((task << 32) + n, shards)
                chunk, n = _Chunk(compiled), n + 1
        if chunk.rows:
            yield from chunk.stored_rows((task << 32) + n, shards)

    def encode(blobs: pa.Table) -> pa.Table:
        parts = [_read(x) for x in blobs.column("blob").to_pylist()]
        words = pa.concat_arrays([p.column("word").combine_chunks() for p in parts]).dictionary_encode()
        single = _encoder(vocabulary.value, pattern)._encode_single_piece
        ids = pa.array([single(w) for w in words.dictionary.to_pylist()], pa.large_list(pa.uint32()))
        out, at = [], 0
        for p in parts:
            mine = ids.take(words.indices.slice(at, p.num_rows))
            out.append(_ipc(pa.table({"number": p.column("number"), "ids": mine})))
            at += p.num_rows
        del words, ids, parts
        release()
        return pa.table({"chunk": blobs.column("chunk"), "blob": pa.array(out, pa.binary())})

    def keep(found: pa.Table) -> pa.Table:
        """A chunk's ids as one file: their number per word, and the ids in the order of the words' numbers."""
        chunk = found.column("chunk")[0].as_py()
        words = pa.concat_tables([_read(x) for x in found.column("blob").to_pylist()]).sort_by("number").combine_chunks()
        put_file(f"{path}/{chunk}", _ipc(words.select(["ids"])))
        return pa.table({"chunk": [chunk], "words": [words.num_rows]})

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = joined(batches)
        return _decoded(out, "ids", "decoded", vocabulary.value) if decoded else out

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                rows = _read(b.column("blob")[k].as_py())
                n = rows.column("n").to_numpy()
                if n.any():
                    yield from _joined(rows, n, b.column("places")[k].as_py(),
                                       _read(get_file(f"{path}/{b.column('chunk')[k].as_py()}")))
                else:  # no word, no file
                    yield pa.record_batch([*(rows.column(c).combine_chunks() for c in ("doc_id", "fp")),
                                           pa.array([b""] * len(n), pa.binary())], names=["doc_id", "fp", "ids"])

    rows = stored(keyed(docs, id_col, text_col).mapInArrow(split, _STORED), "words")
    path = scratch_path(spark, "word-ids")
    words = rows.where("shard >= 0").select("chunk", "shard", "blob")
    encoded = words.groupBy("shard").applyInArrow(encode, "chunk long, blob binary")
    stored(encoded.groupBy("chunk").applyInArrow(keep, "chunk long, words long"), "chunks")
    return (rows.where("shard < 0").select("chunk", "blob", "places")
            .mapInArrow(assemble, "doc_id long, fp int, ids binary" + ", decoded binary" * decoded))


def _joined(rows: pa.Table, n: np.ndarray, planes: list[bytes], words: pa.Table) -> Iterator[pa.RecordBatch]:
    """Ids of each row of a chunk: ``words`` has the ids of each word, ``planes`` the word of each position."""
    total = int(n.sum())
    place = np.zeros(total, np.uint32)
    for k, plane in enumerate(planes):
        place |= _expand(plane, total).astype(np.uint32) << np.uint32(8 * k)
    ids = words.column("ids").combine_chunks()
    off = ids.offsets.to_numpy()
    first, size, flat = off[:-1], np.diff(off), ids.values.to_numpy()
    last = np.cumsum(n)
    i = 0
    while i < len(n):  # some rows at a time
        j = max(i + 1, int(np.searchsorted(last, (last[i - 1] if i else 0) + (1 << 19), side="right")))
        mine = place[last[i] - n[i]:last[j - 1]]
        ends = np.append(0, np.cumsum(size[mine]))[np.append(0, last[i:j] - (last[i] - n[i]))] * 4
        blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [
            None, pa.py_buffer(ends.astype(np.int64)),
            pa.py_buffer(flat[ranges(first[mine], size[mine])].astype("<u4").tobytes())]).cast(pa.binary())
        yield pa.record_batch([*(rows.column(c).slice(i, j - i).combine_chunks() for c in ("doc_id", "fp")), blob],
                              names=["doc_id", "fp", "ids"])
        i = j


def _decoded(batches: Iterator[pa.RecordBatch], ids_col: str, out_col: str, vocabulary: bytes) -> Iterator[pa.RecordBatch]:
    """The batches with the bytes of their ids: ids meet the table of token bytes, whose row number is the id."""
    table = _token_table(vocabulary)
    for b in text_batches(batches, ids_col, PIECE_BYTES):
        col = b.column(ids_col)
        filled = pc.fill_null(col, b"").cast(pa.large_binary())
        off = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(col) + 1]
        data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        decoded, ends = [], [np.zeros(1, np.int64)]
        ids, done = data.view("<u4") if len(data) else np.zeros(0, np.uint32), 0
        for i in range(0, len(ids), 1 << 20):
            found = table.take(pa.array(ids[i:i + (1 << 20)]))
            at = np.frombuffer(found.buffers()[1], np.int64)[:len(found) + 1]
            decoded.append(np.frombuffer(found.buffers()[2], np.uint8)[at[0]:at[-1]])
            ends.append(at[1:] - at[0] + done)
            done = int(ends[-1][-1])
        ends = np.concatenate(ends)[off // 4]
        blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(col), [
            None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(decoded).tobytes() if decoded else b"")]).cast(pa.binary())
        if col.null_count:
            blob = pc.if_else(pc.is_null(col), pa.scalar(None, pa.binary()), blob)
        yield pa.RecordBatch.from_arrays([*b.columns, blob], names=[*b.schema.names, out_col])


def decode_ids(rows: DataFrame, ranks: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that the ids in ``ids_col`` stand for (null ids: null)."""
    vocabulary = _vocabulary(rows, ranks)
    schema = StructType([*rows.schema.fields, StructField(out_col, BinaryType())])
    return rows.mapInArrow(lambda batches: _decoded(batches, ids_col, out_col, vocabulary.value), schema)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, ids, decoded`` of each row: texts encoded, and the ids decoded again in the same tasks."""
    return encode_texts(docs, ranks, pattern, id_col, text_col, decoded=True)
