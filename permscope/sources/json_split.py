"""Large JSON exports as many tasks: byte ranges of a file, cut at records.

A byte in the middle of a JSON file does not tell whether it stands inside a
string or how deep.  Each range is therefore scanned once for every state it
could start in, which gives small summaries (end state and change of depth);
the summaries of a file in order give each range its true start; then each range
reads the records that begin in it, going on past its end for the last one.
Every byte is read twice, by independent tasks, and no document limits the size
of a file.

A record is an element (object or array) of the file's array, or the whole
file if it is one object.  Files whose brackets do not balance, with text after
the value, or with a record that is no JSON are quarantined as a whole, like
the whole-file reader does; text between records is not parsed, and strings in
single quotes are not known.  UTF-8 only: bytes of longer characters never look
like quotes or brackets.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permscope.session import checkpointed, let_workers_import
from permscope.sources.acl_json import well_formed

RANGE_BYTES = 64 << 20
STEP = 1 << 20        # bytes scanned at a time
BATCH_BYTES = 8 << 20  # text in one batch of records

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
_STATES = [(0, 0), (0, 1), (1, 1)]  # (escape pending, inside a string)


def open_file(uri: str):
    """(file, size) of a file's URI as Spark's file metadata gives it."""
    if uri.startswith("file:"):
        fs, name = pafs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    else:
        fs, name = pafs.FileSystem.from_uri(uri)
    f = fs.open_input_file(name)
    return f, f.size()


def scan(data: np.ndarray, escape: int, inside: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(places of brackets outside strings, +1 or -1 each, escape pending, inside) of a stretch that starts in a state."""
    quotes = np.flatnonzero(data == 0x22)
    if len(quotes) or escape:
        # a quote is escaped by an odd run of backslashes before it
        run = data == 0x5C
        last = np.maximum.accumulate(np.where(run, -1, np.arange(len(data), dtype=np.int32))) if run.any() else None
        if last is not None:
            before = np.where(quotes > 0, quotes - 1 - last[np.maximum(quotes - 1, 0)], 0)
            before = np.where((quotes > 0) & (last[np.maximum(quotes - 1, 0)] < 0), quotes + escape, before)
        else:
            before = np.zeros(len(quotes), np.int64)
        before = np.where(quotes == 0, escape, before)
        quotes = quotes[before % 2 == 0]
    tail = 0
    while tail < len(data) and data[len(data) - 1 - tail] == 0x5C:
        tail += 1
    pending = (tail + (escape if tail == len(data) else 0)) % 2
    places = np.flatnonzero((data == 0x7B) | (data == 0x5B) | (data == 0x7D) | (data == 0x5D))
    outside = (np.searchsorted(quotes, places) + inside) % 2 == 0
    places = places[outside]
    step = np.where((data[places] == 0x7B) | (data[places] == 0x5B), 1, -1)
    return places, step, pending, (inside + len(quotes)) % 2


def _blocks(f, start: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(start, end, STEP):
        yield at, np.frombuffer(f.read_at(min(STEP, end - at), at), np.uint8)


def _head(f) -> tuple[int, int]:
    """(place of the first byte of the value, that byte); white space and a byte order mark before it are skipped."""
    mark = 3 if bytes(f.read_at(min(3, f.size()), 0)) == b"\xef\xbb\xbf" else 0
    for at, data in _blocks(f, mark, f.size()):
        found = np.flatnonzero(~_SPACE[data])
        if len(found):
            return at + int(found[0]), int(data[found[0]])
    return f.size(), 0


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range and start state: end state and change of depth."""
    for b in batches:
        out: list[list] = [[] for _ in range(5)]
        for uri, start, end in zip(*(b.column(c).to_pylist() for c in ("source_file", "start", "end"))):
            f, _ = open_file(uri)
            state = {s: (*s, 0) for s in _STATES}
            for _, data in _blocks(f, start, end):
                seen: dict = {}
                for s, (escape, inside, depth) in state.items():
                    if (escape, inside) not in seen:
                        _, step, e, i = scan(data, escape, inside)
                        seen[escape, inside] = (e if i else 0, i, int(step.sum()))
                    e, i, d = seen[escape, inside]
                    state[s] = (e, i, depth + d)
            row = [x for s in _STATES for x in state[s]]
            for c, v in zip(out, (uri, start, end, row, list(_head(f)) if start == 0 else None)):
                c.append(v)
        yield pa.record_batch([pa.array(out[0]), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                               pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.list_(pa.int64()))],
                              names=["source_file", "start", "end", "states", "head"])


def _starts(table: pa.Table) -> pa.Table:
    """The true start of each range of one file (rows: its ranges)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    first, kind = rows[0]["head"]
    escape, inside, depth, out = 0, 0, 0, []
    for r in rows:
        out.append((r["source_file"], r["start"], r["end"], escape, inside, depth, first, kind))
        k = 3 * _STATES.index((escape if inside else 0, inside))
        escape, inside, change = r["states"][k:k + 3]
        depth += change
    good = depth == 0 and not inside and kind in (0x7B, 0x5B)
    names = ["source_file", "start", "end", "escape", "inside", "depth", "first", "kind"]
    return pa.table({n: pa.array(c) for n, c in zip(names, zip(*out))} | {"good": pa.array([good] * len(out))})


def _records_of(f, r: dict) -> Iterator[tuple[bool, bytes]]:
    """(bad, text) of the records that begin in a range; bad: text after the value."""
    size, end, base = f.size(), r["end"], 1 if r["kind"] == 0x5B else 0
    escape, inside, depth = r["escape"], r["inside"], r["depth"]
    at, held, open_ = r["start"], b"", False
    while at < size and (at < end or open_):
        data = np.frombuffer(f.read_at(min(STEP, (end if at < end else size) - at), at), np.uint8)
        places, step, escape, inside = scan(data, escape, inside)
        after = depth + np.cumsum(step)
        starts = places[(step > 0) & (after == base + 1)].tolist() if at < end else []
        ends = (places[(step < 0) & (after == base)] + 1).tolist()
        done = 0
        if open_:
            if ends:
                yield False, held + data[:ends[0]].tobytes()
                done, ends, held, open_ = ends[0], ends[1:], b"", False
            else:
                held += data.tobytes()
        if at < end:
            if not open_:
                for k, s in enumerate(starts):
                    stop = next((e for e in ends if e > s), None) if k >= len(ends) or ends[k] <= s else ends[k]
                    if stop is None:
                        held, open_ = data[s:].tobytes(), True
                        break
                    yield False, data[s:stop].tobytes()
            # bytes behind the value, or before it in a later range
            whole = np.append(depth, after)
            closed = np.flatnonzero((whole[1:] == 0) & (whole[:-1] > 0))
            begin = int(places[closed[0]]) + 1 if len(closed) else None
            if depth == 0 and at > r["first"]:
                begin = 0
            if begin is not None and not _SPACE[data[begin:]].all():
                yield True, b""
        depth = int(after[-1]) if len(after) else depth
        at += len(data)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            f, _ = open_file(r["source_file"])
            held, size = [], 0
            for bad, text in _records_of(f, r):
                held.append((r["source_file"], bad, text))
                size += len(text)
                if size > BATCH_BYTES:
                    yield _batch(held)
                    held, size = [], 0
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    file, bad, text = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(file, pa.string()), pa.array(bad, pa.bool_()),
                            pa.array([t.decode("utf-8", "replace") for t in text], pa.string())],
                           names=["source_file", "bad", "text"])


def read_split_records(spark: SparkSession, root: str, schema_name_pattern: str = "(?i)schema",
                       range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of the folder-ACL files below ``root``.

    Records: run_id, source_file, file_name, text, ready for ``acl_nodes``;
    quarantine: run_id, source_file, reason.
    """
    let_workers_import(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(root)
             .select(F.col("_metadata.file_path").alias("source_file"), "length"))
    name = F.url_decode(F.regexp_replace(F.regexp_extract("source_file", r"([^/]+)$", 1), r"\+", "%2B"))
    files = files.where(F.col("source_file").contains("folderacls/") & ~name.rlike(schema_name_pattern))
    ranges = files.select("source_file", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                                                              F.lit(range_bytes).cast("long"))).alias("start"), "length")
    # one range a task: hash partitions by range
    ranges = ranges.select("source_file", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    summary = ranges.repartition(spread, "source_file", "start").mapInArrow(
        _summaries, "source_file string, start long, end long, states array<long>, head array<long>")
    starts = checkpointed(summary.groupBy("source_file").applyInArrow(
        _starts, "source_file string, start long, end long, escape long, inside long, depth long, first long, kind long, good boolean"))
    rows = checkpointed(starts.where("good").repartition(spread, "source_file", "start").mapInArrow(
        _records, "source_file string, bad boolean, text string"))
    run = F.regexp_extract("source_file", r"([^/]+)/folderacls/[^/]*$", 1).alias("run_id")
    broken = (starts.where("not good").select("source_file")
              .unionByName(rows.where(F.col("bad") | ~well_formed(F.col("text"))).select("source_file"))).distinct()
    broken = checkpointed(broken)
    records = rows.where("not bad").join(broken, "source_file", "left_anti")
    return (records.select(run, "source_file", name.alias("file_name"), "text"),
            broken.select(run, "source_file", F.lit("unparsable JSON").alias("reason")))
