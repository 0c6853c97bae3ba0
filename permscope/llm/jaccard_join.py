"""Operator 8: n-gram Jaccard join by universe partitioning and the pigeonhole principle.

A document's set holds the hashes of its distinct word n-grams.  Sets of one
size band differ from a partner in at most H tokens, so when the token universe
is hashed into m segments with allowances t_i (1: the segment must be equal;
2: equal up to one deletion) that add up to H + c, matched segments of a linked
pair are worth c at least.  A set therefore indexes

* its equality segments, except c - 1 of the poorest (fewest tokens, then
  smallest value: the same order for both partners, so a common one is left);
* for the first y segments the segment and its one-deletion neighbourhood.
  Segment hashes are sums, so a deletion is one subtraction.

(c, y) of a band minimise signatures plus expected chance pairs (a pair costs as
much as shipping its texts), from the sizes of all sets.  Every signature group
compares its members to a few of them (a star); pairs whose parity sketches
differ in more bits than linked sets can differ in tokens are dropped; the rest
is compared by counting tokens exactly.  Groups that then still hold several
components are compared in blocks, sketch against sketch inside a task: first
the nearest plausible pair of each two components is counted, then every
plausible pair of components that are still apart.  So every linked pair is
either compared or already in one component, and no group emits all its pairs.

Cases: equal sets are one node, whatever their number; null or wordless text
has an empty set (0 shingles, a component of its own); fewer than n words are
one shingle; a null doc_id takes part, and a component without any doc_id has
a null component_id; an empty table gives an empty result; columns other than
the two named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.llm.blobs import BLOB_SCHEMA, shard_table, to_blobs, unpack_blobs, without
from permscope.llm.superkmers import default_buckets
from permscope.llm.tables import components, joined, stored
from permscope.llm.text import BATCH_BYTES, keyed, mix, ranges, raw_bytes, rolling, text_batches, word_hashes, words_of

SKETCH = 1024        # least bits of a sketch: the parity of the tokens that hash to each
PAIR = 0.5           # cost of comparing a pair, in signatures per token of a set
CENTRES = 2          # of a signature group in the first round
BLOCK = 2048         # members of a group that are compared in one place
STAR = 512           # members that one centre meets in one place; more are dealt to several
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MASK = (1 << 64) - 1


@dataclass
class Sets:
    """Token sets of a batch: sorted distinct tokens, ``off`` per row; ``node`` identifies a set."""

    tokens: np.ndarray
    off: np.ndarray
    node: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.off)


def token_sets(col: pa.Array, n: int) -> Sets:
    data, off = raw_bytes(col)
    w = words_of(_LOWER[data], off)
    count = np.diff(w.doc)
    h = word_hashes(w)
    gram = rolling(h, n)
    long = count >= n
    first = ranges(w.doc[:-1][long], count[long] - n + 1)
    row = np.repeat(np.flatnonzero(long), count[long] - n + 1)
    token = mix(gram[first] + np.uint64(n)) if len(first) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & ~long)
    if len(short):  # the whole sequence as one shingle, told apart by its length
        whole = np.array([int(np.bitwise_xor.reduce(mix(h[i:j] + np.arange(1, j - i + 1, dtype=np.uint64))))
                          for i, j in zip(w.doc[:-1][short].tolist(), w.doc[1:][short].tolist())], np.uint64)
        token = np.concatenate([token, mix(whole + count[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    at = np.argsort(token)
    small = row.astype(np.uint16) if len(count) < 65536 else row
    at = at[np.argsort(small[at], kind="stable")]
    token, row = token[at], row[at]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    token, row = token[keep], row[keep]
    off = np.searchsorted(row, np.arange(len(count) + 1))
    total = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(mix(token + np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    node = mix(total[off[1:]] - total[off[:-1]] + np.diff(off).astype(np.uint64)).view(np.int64)
    return Sets(token, off, node)


# ---------------------------------------------------------------- allocation

@dataclass(frozen=True)
class Plan:
    """Bands of set sizes: ``lower`` bounds, and segments m, deletion segments y, slack c of each."""

    percent: int
    lower: np.ndarray
    m: np.ndarray
    y: np.ndarray
    c: np.ndarray


def bands(percent: int, largest: int) -> np.ndarray:
    """Lower bounds of bands ``(100/percent)**2`` wide, up to ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, out[-1] * 10000 // percent**2 + 1))
    return np.array(out, np.int64)


def allocate(percent: int, lower: np.ndarray, counts: dict[int, int]) -> Plan:
    """The cheapest (c, y) of each band for ``counts`` sets per band."""
    m, y, c = (np.ones(len(lower), np.int64) for _ in range(3))
    for b in range(len(lower) - 1):
        top = int(lower[b + 1]) - 1
        differ = (100 - percent) * 2 * top // (100 + percent)
        size = max(1.0, (lower[b] * percent / 100 + top) / 2)
        n = counts.get(b, 0) + counts.get(b - 1, 0)
        best = None
        for slack in sorted({*range(1, 9), *(int(8 * 1.25**i) for i in range(1, 60) if 8 * 1.25**i < differ)}):
            units = differ + slack
            for dels in sorted({0, units // 8, units // 4, units // 2}):
                seg = units - dels
                if seg < 1 or dels > seg:
                    continue
                k = size / seg
                poor = seg * math.exp(-k) * (1 + k)  # segments of one token at most, and of them left undropped
                left, term = 1.0, math.exp(-poor)
                for i in range(1, slack):
                    left, term = left - term, term * poor / i
                shared = max(left - term, 0.0) ** 2
                chance = (seg - dels) * math.exp(-2 * k) * shared + dels * (math.exp(-k) * (1 + k))**2
                cost = n * ((seg - dels) + dels * (1 + k)) + n * n / 2 * chance * PAIR * size
                if best is None or cost < best[0]:
                    best = (cost, seg, dels, slack)
        _, m[b], y[b], c[b] = best
    return Plan(percent, lower, m, y, c)


def signatures(sets: Sets, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of every set: its own band's scheme and, near its top, the next band's."""
    size = sets.sizes()
    band = np.searchsorted(plan.lower, size, side="right") - 1
    row = np.flatnonzero(size > 0)
    nxt = row[plan.lower[np.minimum(band[row] + 1, len(plan.lower) - 1)] * plan.percent <= size[row] * 100]
    row, scheme = np.concatenate([row, nxt]), np.concatenate([band[row], band[nxt] + 1])
    if not len(row):
        return np.zeros(0, np.uint64), row
    m, y = plan.m[scheme], plan.y[scheme]
    base = np.cumsum(m) - m
    who = np.repeat(np.arange(len(row)), size[row])
    token = sets.tokens[ranges(sets.off[:-1][row], size[row])]
    place = (mix(token + scheme[who].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
    place = (place * m[who]) >> 31
    value = mix(token ^ np.uint64(0xD1B54A32D192ED03))
    at = base[who] + place
    total = np.zeros(int(m.sum()), np.uint64)
    np.add.at(total, at, value)
    count = np.bincount(at, minlength=len(total))
    owner = np.repeat(np.arange(len(row)), m)
    segment = np.arange(len(total)) - base[owner]
    tag = mix((scheme[owner].astype(np.uint64) << np.uint64(32)) + segment.astype(np.uint64))
    out = np.ones(len(total), bool)
    poor = np.flatnonzero((count <= 1) & (segment >= y[owner]))
    poor = poor[np.lexsort((total[poor], count[poor], owner[poor]))]
    rank = np.arange(len(poor)) - np.searchsorted(owner[poor], owner[poor])
    out[poor[rank < plan.c[scheme[owner[poor]]] - 1]] = False
    keep = np.flatnonzero(out)
    gone = np.flatnonzero(place < y[who])  # one-deletion neighbourhoods
    sig = np.concatenate([mix(total[keep] ^ tag[keep]), mix((total[at[gone]] - value[gone]) ^ tag[at[gone]])])
    return sig, np.concatenate([row[owner[keep]], row[who[gone]]])


# ---------------------------------------------------------------- candidates

def _signature_rows(docs: DataFrame, n: int, plan: Plan, buckets: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, limit=BATCH_BYTES // 4):  # segments take some hundred bytes a token
            sets = token_sets(b.column("text"), n)
            sig, row = signatures(sets, plan)
            node = sets.node[row]
            bucket = (sig % np.uint64(buckets)).astype(np.int32)
            at = np.lexsort((node, bucket))
            same = (sig[at][1:] == sig[at][:-1]) & (node[at][1:] == node[at][:-1])
            at = at[np.append(True, ~same)] if len(at) else at
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[at]) != 0)), len(at)) if len(at) else [0]
            out: tuple[list, list, list] = ([], [], [])
            for i, j in zip(cuts[:-1], cuts[1:]):
                mine = at[i:j]
                out[0].append(int(bucket[mine[0]]))
                # 48 bits of the signature are enough beside its bucket; a chance match is only compared in vain
                out[1].append(np.ascontiguousarray(sig[mine].view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes())
                out[2].append(node[mine].tobytes())
            yield pa.record_batch([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()),
                                   pa.array(out[2], pa.binary())], names=["bucket", "sigs", "nodes"])

    return docs.select("text").mapInArrow(emit, "bucket int, sigs binary, nodes binary")


def _star(table: pa.Table) -> pa.Table:
    """Centre-member pairs of each signature; members of larger groups too (a null)."""
    raw = np.frombuffer(b"".join(table.column("sigs").to_pylist()), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :6] = raw
    sig = wide.view(np.int64).ravel()
    node = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
    at = np.argsort(sig)
    twin = np.zeros(len(at), bool)
    near = sig[at][1:] == sig[at][:-1]
    twin[1:] |= near
    twin[:-1] |= near
    at = at[twin]
    sig, node = sig[at], node[at]
    at = np.lexsort((node, sig))
    sig, node = sig[at], node[at]
    keep = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])) if len(sig) else np.zeros(0, bool)
    sig, node = sig[keep], node[keep]
    head = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(sig)))
    first, rank = np.repeat(head, size), np.arange(len(sig)) - np.repeat(head, size)
    a, b = [], []
    for k in range(CENTRES):
        m = np.flatnonzero(rank > k)
        a.append(node[first[m] + k])
        b.append(node[m])
    pairs = np.unique(np.column_stack([np.concatenate(a), np.concatenate(b)]), axis=0) if len(sig) else np.zeros((0, 2), int)
    more = np.flatnonzero(np.repeat(size, size) > CENTRES + 1)
    bucket = int(table.column("bucket")[0].as_py())
    return pa.table({
        "sig": pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(sig[more], pa.int64())]),
        "bucket": pa.array([bucket] * (len(pairs) + len(more)), pa.int32()),
        "a": pa.concat_arrays([pa.array(pairs[:, 0], pa.int64()), pa.nulls(len(more), pa.int64())]),
        "b": pa.array(np.concatenate([pairs[:, 1], node[more]]), pa.int64())})


# ---------------------------------------------------------------- verification

def sketches(sets: Sets) -> pa.Array:
    """Parity bits of every set, as many as the next power of two of its size (SKETCH at least).

    Two sets' sketches, folded to one length, differ in at most as many bits
    as the sets in tokens.
    """
    size = sets.sizes()
    bits = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    row = np.repeat(np.arange(len(size)), size)
    bit = (mix(sets.tokens ^ np.uint64(0xA24BAED4963EE407)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(base[row] + bit, minlength=int(bits.sum())).astype(np.uint8) & 1
    packed = np.packbits(odd, bitorder="little").tobytes()
    lo, hi = base // 8, (base + bits) // 8
    return pa.array([packed[i:j] for i, j in zip(lo.tolist(), hi.tolist())], pa.binary())


class Sketches:
    """A column of sketches of several lengths."""

    def __init__(self, column: list[bytes]):
        self.words = np.array([len(x) // 8 for x in column], np.int64)
        self.start = np.cumsum(self.words) - self.words
        self.data = np.frombuffer(b"".join(column), np.uint64)

    def rows(self, at: np.ndarray, words: int, own: int) -> np.ndarray:
        """Sketches ``at`` (all of ``own`` words), folded to ``words`` words."""
        got = self.data[self.start[at][:, None] + np.arange(own)]
        return np.bitwise_xor.reduce(got.reshape(len(at), own // words, words), axis=1)


def sketch_distance(a: Sketches, x: np.ndarray, b: Sketches, y: np.ndarray) -> np.ndarray:
    """Bits in which sketch ``a[x]`` and ``b[y]`` differ."""
    out = np.zeros(len(x), np.int64)
    wide = a.words[x] * (1 << 32) + b.words[y]
    for w in np.unique(wide).tolist():
        m, n = w >> 32, w & 0xFFFFFFFF
        mine = np.flatnonzero(wide == w)
        step = max(1, (1 << 21) // max(m, n))
        for i in range(0, len(mine), step):
            k = mine[i:i + step]
            both = a.rows(x[k], min(m, n), m) ^ b.rows(y[k], min(m, n), n)
            out[k] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return out


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (Sketches(b.column(c).to_pylist()) for c in ("sa", "sb"))
            at = np.arange(b.num_rows)
            differ = sketch_distance(x, at, y, at)
            m, n = b.column("na").to_numpy(), b.column("nb").to_numpy()
            good = ((100 + percent) * differ <= (100 - percent) * (m + n)) & (
                100 * np.minimum(m, n) >= percent * np.maximum(m, n))
            yield b.select(["a", "b"]).filter(pa.array(good))

    known = nodes.select("node", "size", "sketch")
    both = (pairs.join(known.toDF("a", "na", "sa"), "a").join(known.toDF("b", "nb", "sb"), "b")
            .select("a", "b", "na", "nb", "sa", "sb"))
    return both.mapInArrow(test, "a long, b long")


def _first_of_each(pairs: np.ndarray) -> np.ndarray:
    """Of rows (component, component, distance, a, b) the nearest of each two components."""
    pairs = pairs[np.lexsort(pairs.T[::-1])]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)
    return pairs[new]


def _between(groups: DataFrame, comp: DataFrame, nodes: DataFrame, percent: int, shards: int,
             nearest: bool) -> DataFrame:
    """Plausible pairs (a, b) of different components within signature groups (bucket, sig, node).

    With ``nearest`` a task names only the nearest pair of each two components.

    Groups that already are one component have nothing to find.  The others
    are compared in blocks of at most BLOCK members, sketch against sketch
    inside the task; only plausible pairs leave it.
    """
    groups = groups.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = groups.groupBy("bucket", "sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k"))
    mixed = mixed.where("lo != hi").select("bucket", "sig", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    members = groups.join(mixed, ["bucket", "sig"]).join(nodes.select("node", "size", "sketch"), "node")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.withColumn("own", mine).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    place = F.xxhash64("bucket", "sig", F.least("own", "other"), F.greatest("own", "other"))
    placed = placed.select("node", "comp", "size", "sketch", "own", (F.col("own") == F.col("other")).alias("one"),
                           place.alias("place"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        place, node, comp, size, own = (table.column(c).to_numpy() for c in ("place", "node", "comp", "size", "own"))
        one = table.column("one").to_numpy()
        sketch = Sketches(table.column("sketch").to_pylist())
        found: list[np.ndarray] = [np.zeros((0, 5), np.int64)]
        i, step = np.arange(len(place)), 0
        while len(i):  # every member with the one `step` places behind it
            step += 1
            i = i[i + step < len(place)]
            i = i[place[i] == place[i + step]]
            j = i + step
            ok = (comp[i] != comp[j]) & ((own[i] != own[j]) | one[i])
            ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            x, y = i[ok], j[ok]
            differ = sketch_distance(sketch, x, sketch, y)
            good = (100 + percent) * differ <= (100 - percent) * (size[x] + size[y])
            x, y, differ = x[good], y[good], differ[good]
            found.append(np.column_stack([np.minimum(comp[x], comp[y]), np.maximum(comp[x], comp[y]), differ,
                                          np.minimum(node[x], node[y]), np.maximum(node[x], node[y])]))
            if nearest and sum(map(len, found)) > 1 << 18:
                found = [_first_of_each(np.concatenate(found))]
        pairs = np.concatenate(found)
        pairs = np.unique((_first_of_each(pairs) if nearest else pairs)[:, 3:], axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int")
    return placed.groupBy(shard.alias("shard")).applyInArrow(compare, "a long, b long").distinct()


def _verify(pairs: DataFrame, docs: DataFrame, places: DataFrame, n: int, percent: int, shards: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by counting common tokens.

    A centre and its members' texts meet in one place; a centre with many
    members has several places.
    """
    size = pairs.groupBy("a").agg(F.count("*").alias("k"))
    dealt = pairs.join(size, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / STAR)).alias("salt"))
    dealt = dealt.select("a", "b", F.xxhash64("a", "salt").alias("place"))
    wanted = dealt.select(F.col("a").alias("node"), "place", F.lit(True).alias("centre")).distinct().unionByName(
        dealt.select(F.col("b").alias("node"), "place", F.lit(False).alias("centre")))
    wanted = wanted.join(places, "node").select("doc_id", "fp", "node", "place", "centre")

    def pack(batches):
        for b in batches:
            if b.num_rows:
                yield shard_table(pa.Table.from_batches([b]), shards)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        """Texts to the places that want them."""
        rows, want = unpack_blobs(left), unpack_blobs(right)
        empty = pa.table({"shard": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        if rows is None or want is None:
            return empty
        rows = rows.append_column("row", pa.array(np.arange(rows.num_rows)))
        first = rows.select(["doc_id", "fp", "row"]).group_by(["doc_id", "fp"]).aggregate([("row", "min")])
        # a null doc_id joins no key in Arrow: match it as -1 beside a flag
        def key(t):
            return (t.append_column("none", pa.compute.is_null(t.column("doc_id")))
                    .set_column(t.schema.get_field_index("doc_id"), "doc_id", pa.compute.fill_null(t.column("doc_id"), -1)))
        hit = key(want).join(key(first), ["doc_id", "none", "fp"], join_type="inner")
        texts = rows.column("text").take(hit.column("row_min"))
        out = pa.table({"doc_id": hit.column("place"), "fp": pa.array(np.zeros(hit.num_rows, np.int32)),
                        "node": hit.column("node"), "centre": hit.column("centre"), "text": texts})
        parts = [shard_table(pa.Table.from_batches([b]), shards) for b in text_batches(out.combine_chunks().to_batches())]
        return pa.Table.from_batches(parts) if parts else empty

    def compare(table: pa.Table) -> pa.Table:
        rows = unpack_blobs(table).sort_by([("doc_id", "ascending"), ("centre", "descending")]).combine_chunks()
        place, centre = rows.column("doc_id").to_numpy(), rows.column("centre").to_numpy()
        node = rows.column("node").to_numpy()
        a, b = [], []
        mine, own = np.zeros(0, np.uint64), 0
        at = 0
        for batch in text_batches(rows.to_batches()):
            sets = token_sets(batch.column("text"), n)
            size, end = sets.sizes(), at + batch.num_rows
            cuts = [at, *(at + 1 + np.flatnonzero((place[at + 1:end] != place[at:end - 1]))).tolist(), end]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if centre[i]:
                    mine, own = sets.tokens[sets.off[i - at]:sets.off[i - at + 1]], int(node[i])
                    i += 1
                if i == j:
                    continue
                lo, hi = sets.off[i - at], sets.off[j - at]
                k = np.minimum(np.searchsorted(mine, sets.tokens[lo:hi]), max(len(mine) - 1, 0))
                common = np.append(0, np.cumsum(mine[k] == sets.tokens[lo:hi]))[sets.off[i - at:j - at + 1] - lo]
                common = np.diff(common)
                good = 100 * common >= percent * (size[i - at:j - at] + len(mine) - common)
                b.append(node[i:j][good])
                a.append(np.full(good.sum(), own))
            at = end
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": pa.array(np.concatenate(a or none), pa.int64()), "b": pa.array(np.concatenate(b or none), pa.int64())})

    asked = wanted.mapInArrow(pack, BLOB_SCHEMA)
    sent = to_blobs(docs, shards).groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(send, BLOB_SCHEMA)
    return sent.groupBy("shard").applyInArrow(compare, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                       percent: int = 85, buckets: int | None = None) -> DataFrame:
    """``doc_id, fp, n_shingles, component_id, component_fp`` of every input row (fp: hash of a text).

    Two rows link when ``100 * |intersection| >= percent * |union|``;
    component_id is the smallest doc_id reachable by links, component_fp the
    smallest fp of its rows there.
    """
    spark = docs.sparkSession
    shards = buckets or default_buckets(spark)
    docs = keyed(docs, id_col, text_col)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, limit=BATCH_BYTES // 4):
            sets = token_sets(b.column("text"), n)
            yield pa.record_batch([b.column("doc_id"), b.column("fp"), pa.array(sets.node), pa.array(sets.sizes()),
                                   sketches(sets)], names=["doc_id", "fp", "node", "size", "sketch"])

    sets = stored(docs.mapInArrow(describe, "doc_id long, fp int, node long, size long, sketch binary"), "sets")
    nodes = stored(sets.where("size > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "fp")).alias("place"), F.max("size").alias("size"), F.max("sketch").alias("sketch")), "nodes")
    sets = sets.drop("sketch")
    places = nodes.select("node", "place.doc_id", "place.fp")
    lower = bands(percent, (sets.agg(F.max("size")).first()[0] or 1) * 100 // percent + 1)
    bound = F.lit(-1)
    for x in lower.tolist():
        bound = bound + (F.col("size") >= x).cast("int")
    counts = {r["band"]: r["k"] for r in nodes.groupBy(bound.alias("band")).agg(F.count("*").alias("k")).collect()}
    plan = allocate(percent, lower, counts)  # some 40 bands

    found = stored(_signature_rows(docs, n, plan, shards).groupBy("bucket").applyInArrow(
        _star, "sig long, bucket int, a long, b long"), "stars")
    pairs = found.where("a is not null").select("a", "b").distinct()
    groups = found.where("a is null").select("bucket", "sig", F.col("b").alias("node"))
    pairs = stored(_plausible(pairs, nodes, percent), "pairs")
    links = stored(_verify(pairs, docs, places, n, percent, shards), "links")
    comp = components(links)
    for nearest in (True, False):  # most components of a family join by their nearest pairs; then all pairs that are left
        pairs = stored(_between(groups, comp, nodes, percent, shards, nearest), "pairs")
        if not pairs.isEmpty():
            links = stored(_verify(pairs, docs, places, n, percent, shards), "links")
            comp = joined(comp, links)
    sets = sets.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    first = sets.where("size > 0").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("low"))
    none = F.col("size") == 0
    return sets.join(first, "comp", "left").select(
        "doc_id", "fp", F.col("size").alias("n_shingles"),
        F.when(none, F.col("doc_id")).otherwise(F.col("low.doc_id")).alias("component_id"),
        F.when(none, F.col("fp")).otherwise(F.col("low.fp")).alias("component_fp"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                     percent: int = 80, buckets: int | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) without all but the first of each component.

    The first is the smallest doc_id's (then the smallest fp's) row; rows
    without words all stay.
    """
    shards = buckets or default_buckets(docs.sparkSession)
    found = jaccard_components(docs, id_col, text_col, n, percent, buckets)
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("component_fp"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return without(keyed(docs, id_col, text_col, row), found.where(~first), shards, once=True)
