"""Super-k-mer partitioning of fixed-size windows over words or bytes.

Consecutive windows of one row that share the same minimiser (the smallest
hash among the m-grams inside the window) travel as ONE packed string to the
bucket of that minimiser, so equal windows always meet in one bucket.  The
packed strings of a map batch that go to the same bucket are one row of the
shuffle (compressed), which keeps the number of shuffled rows small.

Skew.  (1) Equal packed strings of a map batch are settled there and only the
first document's travel.  (2) A fixed histogram of 65,536 counters over the
minimisers of ALL rows is summed first; the windows of bins far above the mean
travel one by one to the bucket of their own content instead, so a frequent
m-gram in many contexts spreads over all buckets.  Splitting repeats the shared
bytes, so bins that a task holds easily are left whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.llm.blobs import shard_of, to_blobs, unpack_blobs
from permscope.llm.text import mix, ranges, rolling, text_batches

BINS = 1 << 16
# a bin is split by window content when it holds more than HOT_BUCKET of a bucket's
# mean load, 4 times the mean bin, and more super-k-mers than a task easily holds
HOT_BUCKET, HOT_BIN, LARGE = 0.5, 4.0 / BINS, 1 << 17
LEVEL = 6  # of zstd
HELD = 24 << 20  # bytes of strings that a task packs at a time: larger pieces compress better

PACKED_SCHEMA = "bucket int, n int, meta binary, packed binary, size long"
SPAN_SCHEMA = "doc_id long, fp int, s int, e int"
SHARD_SCHEMA = f"shard int, {SPAN_SCHEMA}"
_META = np.dtype([("doc", "<i8"), ("fp", "<i4"), ("start", "<i4"), ("len", "<i4"), ("anchor", "<i4")])


def default_buckets(spark) -> int:
    """Four buckets a shuffle partition: small groups, evenly dealt."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass
class Units:
    """A batch as units: words (``off`` = their byte offsets) or bytes (``off`` None)."""

    buf: np.ndarray
    off: np.ndarray | None
    doc: np.ndarray       # first unit of each row, and the number of units
    content: np.ndarray   # 64-bit content hash of each unit
    n: int


def order_of(content: np.ndarray, m: int) -> np.ndarray:
    """The 32 bits by which minimisers of ``m`` units are compared."""
    return (mix(rolling(content, m)) >> np.uint64(32)).astype(np.uint32)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, size = x, 1
    while size < width:
        step = min(size, width - size)
        n = len(out) - step
        if n <= 0:
            return x[:0]
        out = np.minimum(out[:n], out[step:step + n])
        size += step
    return out


def runs(units: Units, window: int, m: int, anchors: bool = False) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, minimiser, anchor) of each super-k-mer.

    ``anchor`` is the minimiser's first place in the super-k-mer, or ``-1 - place``
    where it recurs in it (only with ``anchors``, else 0).
    """
    none = np.zeros(0, np.int64)
    if units.n < window:
        return none, none, none.astype(np.uint32), none
    order = order_of(units.content, m)
    low = sliding_min(order, window - m + 1)
    begin, end = units.doc[:-1], units.doc[1:]
    edge = np.zeros(units.n + 1, np.int32)
    np.add.at(edge, np.maximum(begin, end - window + 1), 1)
    np.add.at(edge, end, -1)
    at = np.flatnonzero(np.cumsum(edge[:len(low)]) == 0)
    if not len(at):
        return none, none, none.astype(np.uint32), none
    span = window - m + 1
    value = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (value[1:] != value[:-1])
    head = np.flatnonzero(new)
    first, mini = at[head], value[head]
    count = np.diff(np.append(head, len(at)))
    place = np.zeros(len(first), np.int64)
    todo = np.arange(len(first) if anchors else 0)
    for j in range(span):
        hit = order[first[todo] + j] == mini[todo]
        place[todo[hit]] = j
        todo = todo[~hit]
    if anchors:
        place = np.where(recurring(order, first, count, mini, place, span), -1 - place, place)
    return first, count, mini, place


def recurring(order: np.ndarray, first: np.ndarray, count: np.ndarray, mini: np.ndarray, place: np.ndarray,
              span: int) -> np.ndarray:
    """Super-k-mers whose minimiser occurs in them a second time (or might: unusually large ones)."""
    limit = np.uint32(min(8 / span, 0.999) * 2**32)
    small = np.flatnonzero(order < limit).astype(np.uint64)
    seen = np.sort((order[small.astype(np.int64)].astype(np.uint64) << np.uint64(32)) | small)
    twin = np.flatnonzero((seen[1:] >> np.uint64(32)) == (seen[:-1] >> np.uint64(32)))
    here = (seen[twin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    after = (seen[twin + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = np.argsort(here)
    here, after = here[at], after[at]
    out = mini >= limit
    if len(here):
        p = first + place
        k = np.minimum(np.searchsorted(here, p), len(here) - 1)
        out |= (here[k] == p) & (after[k] < first + count - 1 + span)
    return out


def histogram(docs: DataFrame, units_of: Callable, window: int, m: int, buckets: int) -> np.ndarray:
    """Boolean array: bins of minimisers that alone would load a bucket (all rows are counted).

    Equal super-k-mers of a batch count once, as only one of them travels.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for b in text_batches(batches):
            u = units_of(b.column("text"))
            first, size, mini, _ = runs(u, window, m)
            if len(first):
                whole = mini.astype(np.uint64) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                for j in (0, window // 2, window - 1):
                    whole = mix(whole + u.content[first + j])
                _, once = np.unique(whole, return_index=True)
                total += np.bincount(mini[once] >> 16, minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bin", "n"])

    rows = docs.select("text").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(BINS, np.int64)  # at most BINS rows reach the driver
    for r in rows:
        total[r["bin"]] = r["n"]
    return total > max(total.sum() * HOT_BIN, total.sum() / buckets * HOT_BUCKET, LARGE)


def settle(group: np.ndarray, doc: np.ndarray, fp: np.ndarray, within: bool) -> np.ndarray:
    """Which members of each group of equal strings repeat an earlier one.

    Rows must come sorted by (doc, fp, start).  A member repeats if its group
    has a smaller doc; with ``within`` also if the same row has it before.
    """
    low = np.full(int(group.max()) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(low, group, doc)
    out = doc > low[group]
    if within and len(group):
        at = np.argsort(group, kind="stable")
        same = (group[at][1:] == group[at][:-1]) & (doc[at][1:] == doc[at][:-1]) & (fp[at][1:] == fp[at][:-1])
        out[at[1:][same]] = True
    return out


def exchange(docs: DataFrame, units_of: Callable, window: int, m: int, buckets: int, within: bool) -> DataFrame:
    """Rows ``bucket, n, meta, packed, size``: the super-k-mers of ``doc_id, fp, text``.

    A member of ``meta`` with ``len`` < 0 is already settled: its ``-len``
    windows repeat an earlier document and carry no string.
    """
    hot = histogram(docs, units_of, window, m, buckets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = pa.Codec("zstd", compression_level=LEVEL)
        held: dict[int, list] = defaultdict(list)  # (members, strings) of the batches that are not packed yet
        size = 0

        def packed_rows() -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], []]
            for bucket in sorted(held):
                meta = np.concatenate([m for m, _ in held[bucket]])
                packed = b"".join([x for _, x in held.pop(bucket)])
                cols = b"".join(np.ascontiguousarray(meta[f]).tobytes() for f in _META.names)
                for c, v in zip(out, (bucket, len(meta), zstd.compress(cols, asbytes=True),
                                      zstd.compress(packed, asbytes=True), len(packed))):
                    c.append(v)
            return pa.record_batch([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()),
                                    pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary()),
                                    pa.array(out[4], pa.int64())], names=["bucket", "n", "meta", "packed", "size"])

        for b in text_batches(batches):
            b = b.filter(b.column("doc_id").is_valid())
            if not b.num_rows:
                continue
            b = pa.Table.from_batches([b]).sort_by([("doc_id", "ascending"), ("fp", "ascending")]).combine_chunks()
            ids, fps = b.column("doc_id").to_numpy(), b.column("fp").to_numpy()
            u = units_of(b.column("text").chunk(0))
            first, count, mini, place = runs(u, window, m, anchors=within)
            if not len(first):
                continue
            data, byte = u.buf.tobytes(), u.off if u.off is not None else np.arange(u.n + 1)

            def strings(first, count):
                return [data[i:j] for i, j in zip(byte[first].tolist(), byte[first + count + window - 1].tolist())]

            def settled(first, string):
                row = np.searchsorted(u.doc, first, side="right") - 1
                group = pa.array(string, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                return row, settle(group, ids[row], fps[row], within)

            key, string = mini.astype(np.uint64), strings(first, count)
            row, repeat = settled(first, string)
            split = hot[mini >> 16] & ~repeat
            if split.any():
                alone = ranges(first[split], count[split])
                whole = np.zeros(len(alone), np.uint64)
                for j in range(window):
                    whole = mix(whole + u.content[alone + j])
                one = np.ones(len(alone), np.int64)
                more = strings(alone, one)
                more_row, more_repeat = settled(alone, more)
                string = [string[k] for k in np.flatnonzero(~split).tolist()] + more
                first, count, key, place, row, repeat = (
                    np.concatenate([x[~split], y]) for x, y in
                    ((first, alone), (count, one), (key, whole), (place, one * 0), (row, more_row), (repeat, more_repeat)))
            bucket = (mix(key) % np.uint64(buckets)).astype(np.int32)
            meta = np.zeros(len(first), _META)
            meta["doc"], meta["fp"], meta["anchor"] = ids[row], fps[row], place
            meta["start"] = first - u.doc[row]
            meta["len"] = np.where(repeat, -count, byte[first + count + window - 1] - byte[first])
            at = np.argsort(bucket, kind="stable")
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[at]) != 0)), len(at))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                mine = at[i:j]
                packed = b"".join([string[k] for k in mine[~repeat[mine]].tolist()])
                held[int(bucket[mine[0]])].append((meta[mine], packed))
                size += len(packed)
            if size >= HELD:
                yield packed_rows()
                size = 0
        if held:
            yield packed_rows()

    return docs.select("doc_id", "fp", "text").mapInArrow(pack, PACKED_SCHEMA)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(meta, bytes of the open members one after another, start of each member's bytes)."""
    metas, strings = [], []
    for n, meta, packed, size in zip(*(table.column(c).to_pylist() for c in ("n", "meta", "packed", "size"))):
        cols = pa.decompress(meta, n * _META.itemsize, "zstd", asbytes=True)
        part = np.zeros(n, _META)
        at = 0
        for f in _META.names:
            width = _META[f].itemsize * n
            part[f] = np.frombuffer(cols[at:at + width], _META[f])
            at += width
        metas.append(part)
        strings.append(pa.decompress(packed, size, "zstd", asbytes=True) if size else b"")
    meta = np.concatenate(metas) if metas else np.zeros(0, _META)
    size = np.maximum(meta["len"], 0).astype(np.int64)
    return meta, np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size


def spans_table(doc: np.ndarray, fp: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Table:
    """Spans ``[s, e)`` of units, touching and overlapping ones of a row joined."""
    if len(doc):
        at = np.lexsort((s, fp, doc))
        doc, fp, s, e = doc[at], fp[at], s[at], e[at]
        new = np.ones(len(doc), bool)
        same = (doc[1:] == doc[:-1]) & (fp[1:] == fp[:-1])
        new[1:] = ~(same & (s[1:] <= e[:-1]))
        head = np.flatnonzero(new)
        doc, fp, s = doc[head], fp[head], s[head]
        e = np.maximum.reduceat(e, head)
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "fp": pa.array(fp, pa.int32()),
                     "s": pa.array(s, pa.int32()), "e": pa.array(e, pa.int32())})


def dealt(spans: pa.Table, shards: int) -> pa.Table:
    """The spans with their ``shard`` (``SHARD_SCHEMA``)."""
    return spans.add_column(0, "shard", pa.array(shard_of(spans.column("doc_id"), spans.column("fp"), shards), pa.int32()))


def apply_spans(docs: DataFrame, spans: DataFrame, cut: Callable, schema: str, shards: int) -> DataFrame:
    """``cut`` over all rows of ``docs`` (doc_id, fp, text, row), each with its ``spans`` (blobs, or rows of ``SHARD_SCHEMA``).

    ``cut(rows, base, s, e)`` gets a slice of rows and the spans ``[s, e)`` of
    row ``base``; it returns a record batch of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def per_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, span = unpack_blobs(left), unpack_blobs(right) if "blob" in right.column_names else right
        out = []
        if rows is not None:
            doc, fp = rows.column("doc_id"), rows.column("fp").to_numpy()
            known = np.unique(pc.drop_null(doc).to_numpy())
            no_id = pc.is_null(doc).to_numpy()

            def key(doc, fp):
                return (np.searchsorted(known, doc) << 31) + fp

            mine = np.where(no_id, -1, key(pc.fill_null(doc, 0).to_numpy(), fp))
            if span is not None:
                theirs = key(span.column("doc_id").to_numpy(), span.column("fp").to_numpy())
                at = np.argsort(theirs, kind="stable")
                lo = np.searchsorted(theirs[at], mine, "left")
                n = np.searchsorted(theirs[at], mine, "right") - lo
                pick = at[ranges(lo, n)]
                base = np.repeat(np.arange(len(mine)), n)
                s, e = (span.column(c).to_numpy()[pick].astype(np.int64) for c in ("s", "e"))
            else:
                base = s = e = np.zeros(0, np.int64)
            done = 0
            for b in text_batches(rows.to_batches()):
                i, j = np.searchsorted(base, [done, done + b.num_rows])
                out.append(cut(b, base[i:j] - done, s[i:j], e[i:j]))
                done += b.num_rows
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(b.columns, names=arrow.names) for b in out]).cast(arrow) \
            if out else arrow.empty_table()

    return to_blobs(docs, shards).groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(per_shard, schema)
