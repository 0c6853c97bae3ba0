import pytest
from brute import sha256, substring_dedup, suffix_dedup
from conftest_path import SF_SMALL

from permscope.llm.blobs import rows_of
from permscope.llm.queries import QUERIES
from permscope.llm.substring_dedup import dedup_substrings, repeated_spans
from permscope.llm.suffix_dedup import dedup_bytes
from permscope.llm import superkmers as sk


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("window,hot", [(13, False), (5, False), (5, True)])
def test_substring_dedup_is_exact(spark, odd_docs, odd_rows, window, hot, monkeypatch):
    if hot:  # every bin is split by window content
        monkeypatch.setattr(sk, "histogram", lambda *a: __import__("numpy").ones(sk.BINS, bool))
    got = [(r.row.doc_id, r.n_words, r.n_removed, r.kept_text)
           for r in dedup_substrings(odd_docs, window=window).collect()]
    assert order(got) == order(substring_dedup(odd_rows, window))


def test_substring_dedup_keeps_every_column(odd_docs):
    got = dedup_substrings(odd_docs)
    assert got.select("row.*").columns == odd_docs.columns
    assert order(map(tuple, got.select("row.*").collect())) == order(map(tuple, odd_docs.collect()))


@pytest.mark.parametrize("length,hot,batch", [(100, False, 1 << 15), (30, False, 7), (30, True, 50), (16, False, 64)])
def test_suffix_dedup_is_exact(spark, odd_docs, odd_rows, length, hot, batch, monkeypatch):
    if hot:
        monkeypatch.setattr(sk, "histogram", lambda *a: __import__("numpy").ones(sk.BINS, bool))
    got = [(r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in dedup_bytes(odd_docs, length=length, batch_records=batch).collect()]
    assert order(got) == order(suffix_dedup(odd_rows, length))


def test_periodic_texts(spark):
    rows = [(1, "abc" * 100), (2, "abcd" * 40 + "abc" * 40), (3, "a" * 500), (4, "ba" + "a" * 130), (5, "abc" * 34)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in dedup_bytes(docs).collect()]
    assert order(got) == order(suffix_dedup(rows, 100))


def test_spans_as_rows(spark, odd_docs):
    spans = rows_of(repeated_spans(odd_docs), sk.SPAN_SCHEMA)
    assert spans.columns == ["doc_id", "fp", "s", "e"] and spans.where("e - s < 13").count() == 0


def test_tasks_pack_their_batches_together(spark, odd_docs):
    from permscope.llm.suffix_dedup import byte_units
    from permscope.llm.suffix_dedup import repeated_spans as byte_spans
    from permscope.llm.text import keyed

    arrow = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(arrow)
    docs = odd_docs.unionByName(odd_docs.selectExpr("doc_id + 1000 AS doc_id", *[c for c in odd_docs.columns if c != "doc_id"]))
    docs = docs.select(odd_docs.columns).coalesce(1)
    try:
        spark.conf.set(arrow, "3")
        packed = sk.exchange(keyed(docs, "doc_id", "text"), byte_units, 100, 16, 8, within=True)
        assert 1 < packed.count() <= 8  # a row per bucket, not per bucket and batch
        spans = byte_spans(docs, buckets=64)
        assert spans.columns == ["shard", "doc_id", "fp", "s", "e"] and spans.count() > 1
    finally:
        spark.conf.set(arrow, before)


def test_blobs_keep_a_text_once(spark):
    from pyspark.sql import functions as F

    from permscope.llm.blobs import to_blobs
    from permscope.llm.text import keyed

    many = F.concat(*(F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(20)))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.when(F.col("id") != 7, many).alias("text"), F.lit("x").alias("lang"))
    every = keyed(docs, "doc_id", "text", F.struct(*docs.columns).alias("row"))
    blobs = to_blobs(every, 4)
    assert sum(len(r.blob) for r in blobs.collect()) < 0.7 * sum(len(r.blob) for r in to_blobs(
        every.withColumn("row", F.col("row").withField("text", F.concat(F.col("row.text"), F.lit(" ")))), 4).collect())
    back = rows_of(blobs, every.schema.simpleString()[7:-1].replace(":", " ", 3).replace("row:", "row "))
    assert sorted(map(str, back.collect())) == sorted(map(str, every.collect()))


def test_empty_tables(no_docs):
    assert dedup_substrings(no_docs).count() == 0
    assert dedup_bytes(no_docs).count() == 0


def test_level_family_is_logarithmic():
    import numpy as np

    from permscope.llm.suffix_dedup import LevelFamily

    n, rng = 64, np.random.default_rng(1)
    data = rng.integers(0, 250, (n, 120)).astype(np.uint8)
    meta = np.zeros(n, sk._META)
    meta["doc"], meta["len"] = np.arange(n), 120
    family = LevelFamily(meta, data.ravel(), np.arange(n) * 120, 100)
    for i in range(0, n, 4):
        family.add(np.arange(i, i + 4))
        assert len(family.levels) <= np.log2(i // 4 + 1) + 1
        assert all((k[1:] >= k[:-1]).all() for k, _, _ in family.levels)
    assert sorted(b for _, _, b in family.levels) == [16]


def test_minimisers_that_collide(monkeypatch):
    """Eight hash values only: different 16-byte strings are one record's minimiser, and no repeat is missed."""
    import random

    import numpy as np
    import pyarrow as pa

    from permscope.llm.suffix_dedup import LevelFamily, byte_units

    real = sk.order_of
    monkeypatch.setattr(sk, "order_of", lambda content, m: real(content, m) >> np.uint32(29) << np.uint32(29))
    rng, length = random.Random(4), 40
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [prose(rng.randint(40, 90)) for _ in range(12)]
    texts = [prose(rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 20):] + prose(30) for _ in range(120)]
    units = byte_units(pa.array(texts))
    first, count, mini, place = sk.runs(units, length, 16, anchors=True)
    doc = np.searchsorted(units.doc, first, side="right") - 1
    meta = np.zeros(len(first), sk._META)
    meta["doc"], meta["start"], meta["len"], meta["anchor"] = doc, first - units.doc[doc], count + length - 1, place
    found = set()
    for value in np.unique(mini):
        mine = np.flatnonzero(mini == value)
        family = LevelFamily(meta[mine], units.buf, first[mine], length)
        assert len(family.more[0]) or len(mine) < 20
        for i in range(0, len(mine), 16):
            rec, offset = family.add(np.arange(i, min(i + 16, len(mine))))
            found |= set(zip(meta["doc"][mine][rec].tolist(), (meta["start"][mine][rec] + offset).tolist()))
    seen, want = set(), set()
    for d, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            if t[k:k + length] in seen:
                want.add((d, k))
            seen.add(t[k:k + length])
    assert found == want and len(want) > 100


def test_op2_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = order(map(tuple, QUERIES["op2_suffix_dedup"](spark, SF_SMALL).collect()))
    assert got == order((i, n, k, s, sha256(b)) for i, n, k, s, b in suffix_dedup(rows, 100))
