"""Operator 7: benchmark decontamination by spaced-seed hashing.

A document holds a benchmark item when ``WINDOW`` consecutive words of it equal
as many consecutive words of the item in all but ``SUBSTITUTIONS`` places (A-Z
lower-cased).  An item of fewer words must occur whole and unchanged, even a
single word; over characters where its script has no spaces between words.  Two fixed masks look at six
words of eight or nine and ignore the others; wherever two words of thirteen
are substituted, one placement of a mask avoids both (a test tries all cases),
so no such overlap is missed.

Seeds of the items fill a bitmap of fixed size; documents without a seed in it
are done after one pass.  The seeds of the others are joined with the items'
seeds on the hash, which gives (document, item, diagonal), and the words along
the diagonal are compared.  With a benchmark so large that the bitmap fills up,
more documents take part in the join; the result is the same.

``every_overlap`` returns all overlaps of all (document, item) pairs,
``find_overlaps`` keeps one row per document.  Items of fewer than SHORTEST words
are looked up by a hash of the whole item.

Cases: null and empty texts and items hold nothing; items with equal text are
one item (the smallest item_id); a null doc_id is judged like any other; rows
that share a doc_id are judged by their own text; an empty benchmark or table
gives an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permscope.llm.blobs import without
from permscope.llm.superkmers import default_buckets
from permscope.llm.tables import stored
from permscope.llm.text import Words, keyed, mix, raw_bytes, rolling, text_batches, word_hashes, words_of

WINDOW, SUBSTITUTIONS = 13, 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SHORTEST = 8         # words of an item that is looked for
BITS = 1 << 24       # of the bitmap: 2 MB
# characters of scripts without spaces between words (Thai, Lao, Burmese, Khmer, kana, Han)
UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_UNSPACED = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in UNSPACED) + "]"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
CHARS = 4            # of a seed of such an item
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_words(col: pa.Array) -> Words:
    data, off = raw_bytes(col)
    return words_of(_LOWER[data], off)


def seeds(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, first word, row) of every placement of each mask inside a row."""
    unit = word_hashes(w)
    row = np.repeat(np.arange(len(w.doc) - 1), np.diff(w.doc))
    for k, mask in enumerate(MASKS):
        n = len(w) - mask[-1]
        if n <= 0:
            continue
        h = np.full(n, k + 1, np.uint64)
        for j in mask:
            h = h * np.uint64(0x9E3779B97F4A7C15) + unit[j:j + n]
        at = np.flatnonzero(row[:n] == row[mask[-1]:mask[-1] + n])
        yield mix(h[at]), at, row[at]


def word_seeds(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, first word within the row, row) of every mask placement."""
    w = lower_words(col)
    for h, at, row in seeds(w):
        yield h, at - w.doc[row], row


def _grams(unit: np.ndarray, doc: np.ndarray, sizes: Iterable[int], whole: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, place, row) of every run of each size; ``whole``: only of whole rows, of their first ``whole`` units at most."""
    row = np.repeat(np.arange(len(doc) - 1), np.diff(doc))
    for n in sizes:
        if n > len(unit):
            continue
        at = np.flatnonzero(row[:len(unit) - n + 1] == row[n - 1:])
        if whole:
            at = at[(at == doc[row[at]]) & (np.minimum(np.diff(doc)[row[at]], whole) == n)]
        yield mix(rolling(unit, n)[at] + np.uint64(n)), at - doc[row[at]], row[at]


def short_seeds(col: pa.Array, whole: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    w = lower_words(col)
    return _grams(word_hashes(w), w.doc, range(1, SHORTEST), SHORTEST if whole else 0)


def char_seeds(col: pa.Array, whole: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    col = pc.ascii_lower(pc.fill_null(col, ""))
    if not whole:  # texts without such characters have no seed
        col = pc.if_else(pc.match_substring_regex(col, _UNSPACED), col, "")
    doc = np.append(0, np.cumsum(pc.utf8_length(col).to_numpy(zero_copy_only=False).astype(np.int64)))
    points = np.frombuffer("".join(col.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    return _grams(mix(points), doc, range(1, CHARS + 1), CHARS if whole else 0)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(BITS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(BITS - 1)).astype(np.int64)


def _bitmap(items: DataFrame, seeds_of: Callable = word_seeds) -> np.ndarray:
    """Both bits of every item seed, packed; partial bitmaps meet in a tree."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(BITS, bool)
        for b in text_batches(batches):
            for h, _, _ in seeds_of(b.column("text")):
                for bit in _bits(h):
                    on[bit] = True
        yield pa.record_batch([pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())], names=["bits"])

    parts = items.select("text").mapInArrow(fill, "bits binary").rdd.map(lambda r: np.frombuffer(r[0], np.uint8))
    return parts.treeReduce(np.bitwise_or) if parts.getNumPartitions() else np.zeros(BITS // 8, np.uint8)


def _inside(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    a, b = _bits(h)
    hit = (bitmap[a >> 3] >> (a & 7).astype(np.uint8)) & 1 > 0
    hit[hit] = (bitmap[b[hit] >> 3] >> (b[hit] & 7).astype(np.uint8)) & 1 > 0
    return hit


def overlaps(doc: np.ndarray, item: np.ndarray, diagonal: int) -> list[tuple[int, int, int]]:
    """(first word, words, equal words) of the overlaps along a diagonal.

    ``doc[i]`` lies beside ``item[i - diagonal]``.
    """
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    if hi <= lo:
        return []
    same = doc[lo:hi] == item[lo - diagonal:hi - diagonal]
    if len(item) < WINDOW:
        return [(lo, len(item), len(item))] if hi - lo == len(item) and same.all() else []
    if len(same) < WINDOW:
        return []
    total = np.append(0, np.cumsum(same))
    good = np.flatnonzero(total[WINDOW:] - total[:-WINDOW] >= WINDOW - SUBSTITUTIONS)
    if not len(good):
        return []
    cut = np.flatnonzero(np.diff(good) > WINDOW)  # windows that touch are one overlap
    first, last = good[np.append(0, cut + 1)], good[np.append(cut, len(good) - 1)] + WINDOW
    out = []
    for i, j in zip(first.tolist(), last.tolist()):
        inside = np.flatnonzero(same[i:j])
        i, j = i + int(inside[0]), i + int(inside[-1]) + 1  # ends on equal words
        out.append((lo + i, j - i, int(total[j] - total[i])))
    return out


def char_overlaps(text: str, item: str, place: int) -> list[tuple[int, int, int]]:
    """The same of an item that must occur whole from a character on."""
    if text[place:place + len(item)] != item:
        return []
    n = len(_WORD.findall(item))
    return [(len(_WORD.findall(text[:place + 1])) - 1, n, n)]


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    items = (benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                              F.col(f"`{item_text_col}`").cast("string").alias("text"))
             .where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
             .withColumn("bid", F.xxhash64("text")))
    return stored(items, "items")


def _search(docs: DataFrame, items: DataFrame, every: bool, seeds_of: Callable = word_seeds,
            item_seeds_of: Callable = word_seeds) -> DataFrame:
    """``doc_id, fp, item_id, first_word, n_words, n_equal`` of the longest overlap of each pair, or of every one."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(items) if seeds_of is word_seeds else _bitmap(items, item_seeds_of))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            found = [(h[k], at[k], row[k]) for h, at, row in seeds_of(b.column("text")) for k in [_inside(bitmap.value, h)]]
            h, at, row = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
            order = np.argsort(row, kind="stable")
            h, at, row = h[order], at[order], row[order]
            rows, first = np.unique(row, return_index=True)
            off = pa.array(np.append(first, len(row)).astype(np.int32))
            place = at.astype(np.int32)
            yield pa.record_batch([*(b.column(c).take(pa.array(rows)) for c in ("doc_id", "fp", "text")),
                                   pa.ListArray.from_arrays(off, pa.array(h.view(np.int64))),
                                   pa.ListArray.from_arrays(off, pa.array(place))],
                                  names=["doc_id", "fp", "text", "hashes", "places"])

    likely = stored(docs.mapInArrow(sift, "doc_id long, fp int, text string, hashes array<long>, places array<int>"), "likely")

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            bid = b.column("bid").to_numpy()
            for h, at, row in item_seeds_of(b.column("text")):
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(bid[row]),
                                       pa.array(at.astype(np.int32))], names=["hash", "bid", "item_place"])

    theirs = items.mapInArrow(item_seeds, "hash long, bid long, item_place int").distinct()
    mine = likely.select("doc_id", "fp", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "doc_id", "fp", F.col("s.hashes").alias("hash"), F.col("s.places").alias("place"))
    diagonals = mine.join(theirs, "hash").select(
        "doc_id", "fp", "bid", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct()
    per_pair = diagonals.groupBy(F.col("doc_id").alias("hit_id"), F.col("fp").alias("hit_fp"), "bid").agg(
        F.collect_list("diagonal").alias("diagonals"))  # bounded by the document's length
    pairs = (likely.select("doc_id", "fp", "text").distinct()
             .join(per_pair, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("fp") == F.col("hit_fp")))
             .join(items.select("bid", "item_id", F.col("text").alias("item_text")), "bid"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            n = b.num_rows
            w = lower_words(pa.concat_arrays([b.column("text"), b.column("item_text")]))
            ids, _ = w.ids()
            out: list[list] = [[], [], [], []]
            texts, them = (pc.ascii_lower(b.column(c)).to_pylist() if seeds_of is char_seeds else None for c in ("text", "item_text"))
            for k, diagonals in enumerate(b.column("diagonals").to_pylist()):
                doc, item = ids[w.doc[k]:w.doc[k + 1]], ids[w.doc[n + k]:w.doc[n + k + 1]]
                if seeds_of is word_seeds and len(item) < SHORTEST:
                    continue
                found = sorted({x for d in sorted(diagonals) for x in (
                    char_overlaps(texts[k], them[k], d) if texts else overlaps(doc, item, d))})
                if not every:
                    found = [max(found, key=lambda x: (x[1], x[2], -x[0]))] if found else []
                for x in found:
                    for c, v in zip(out, (k, *x)):
                        c.append(v)
            at = pa.array(out[0], pa.int64())
            yield pa.record_batch([*(b.column(c).take(at) for c in ("doc_id", "fp", "item_id")),
                                   *(pa.array(x, pa.int32()) for x in out[1:])],
                                  names=["doc_id", "fp", "item_id", "first_word", "n_words", "n_equal"])

    return pairs.select("doc_id", "fp", "text", "item_id", "item_text", "diagonals").mapInArrow(
        verify, "doc_id long, fp int, item_id long, first_word int, n_words int, n_equal int")


def every_overlap(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, fp, item_id, first_word, n_words, n_equal`` of every overlap of every document and item, short ones too."""
    return _overlaps(keyed(docs, id_col, text_col), _items(benchmark, item_col, item_text_col), True)


def _overlaps(docs: DataFrame, items: DataFrame, every: bool) -> DataFrame:
    """Overlaps with all items, short ones too: the longest of each pair, or every one."""
    n = F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    short = items.where(n.between(1, SHORTEST - 1))
    # spaces around an item are no part of it
    chars = short.where(F.col("text").rlike(_UNSPACED)).withColumn("text", F.regexp_replace(
        "text", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    out = _search(docs, items, every)
    for some, seeds in ((short.where(~F.col("text").rlike(_UNSPACED)), short_seeds), (chars, char_seeds)):
        if not some.isEmpty():  # most benchmarks have none
            out = out.unionByName(_search(docs, some, every, seeds, partial(seeds, whole=True)))
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document that holds a benchmark item.

    ``doc_id, fp, item_id, n_items, first_word, n_words, n_equal``: the item of
    the longest overlap (the smallest item_id among equals), the number of
    items found, and the overlap's place and equal words.
    """
    docs = keyed(docs, id_col, text_col)
    hits = _overlaps(docs, _items(benchmark, item_col, item_text_col), False)
    best = F.max(F.struct("n_words", "n_equal", (-F.col("item_id")).alias("low"), (-F.col("first_word")).alias("early")))
    return hits.groupBy("doc_id", "fp").agg(best.alias("b"), F.count("*").cast("int").alias("n_items")).select(
        "doc_id", "fp", (-F.col("b.low")).alias("item_id"), "n_items", (-F.col("b.early")).alias("first_word"),
        F.col("b.n_words").alias("n_words"), F.col("b.n_equal").alias("n_equal"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that hold no benchmark item."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = find_overlaps(docs, benchmark, id_col, text_col, **names)
    return without(keyed(docs, id_col, text_col, row), found, default_buckets(docs.sparkSession))
