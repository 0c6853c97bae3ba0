import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import base_counts
from conftest_path import SF_CHECK
from hypothesis import given, settings
from hypothesis import strategies as st

from permscope.llm import quality_classifier as qc
from permscope.llm import quality_rules as qr
from permscope.llm.queries import QUERIES
from permscope.llm.stats import BASE, FEATURES, statistics


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \n#|é\t\x1c", max_size=60), max_size=5))
def test_base_counts(rows):
    base, features = statistics(pa.array(rows, pa.string()))
    assert [tuple(r) for r in base.tolist()] == [base_counts(t) for t in rows]
    assert features.shape == (len(rows), len(FEATURES)) and np.isfinite(features).all()


def test_forest_isolates_unusual_rows():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 0.05, (2000, 4))
    forest = qr.fit_forest(good)
    assert forest.score(good).max() < forest.score(np.full((1, 4), 1.0))[0]
    again = qr.fit_forest(good)
    assert (forest.score(good) == again.score(good)).all()


def test_judge_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(None, 1, 0), (1, None, 0), (5, 0, 0), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = qr.judge(odd_docs, labels, keep_row=True).collect()
    want = sorted((i is not None, i or 0, *base_counts(t)) for i, t in odd_rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, *(r[c] for c in BASE)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert r.row.doc_id == r.doc_id and r.row.row == "x"
    assert qr.judge(no_docs, labels).count() == 0
    bare = qr.judge(odd_docs, labels.limit(0)).collect()  # without labels only the base rules reject
    assert all(r.kept != r.base_failed for r in bare)


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_op9_keeps_good_rows_and_catches_bad_ones(spark):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF_CHECK).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert {i: tuple(got[i][c] for c in BASE) for i in got} == {i: base_counts(t) for i, t in texts.items()}
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id] for r in labels if r.quality == 0 and not got[r.doc_id].base_failed]
    assert np.mean([r.kept for r in good]) >= 0.99
    assert np.mean([r.kept for r in bad]) <= 0.1


def test_op4_on_the_held_out_fold(spark):
    got = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, SF_CHECK).collect()}
    for i, r in got.items():
        assert r.held_out == (fold(i) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = [r for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(labels) > 40
    assert np.mean([got[r.doc_id].predicted == r.quality for r in labels]) >= 0.95


def test_classifier_never_reads_held_out_labels(spark, odd_docs):
    rows = [(k, k % 2) for k in range(40)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    flipped = spark.createDataFrame([(k, 1 - q if fold(k) == 0 else q) for k, q in rows], "doc_id long, quality int")
    a, b = (sorted((r.doc_id or -1, r.score) for r in qc.classify(odd_docs, x).collect()) for x in (labels, flipped))
    assert a == pytest.approx(b) if not isinstance(a[0], tuple) else [x[0] for x in a] == [x[0] for x in b]
    assert np.allclose([x[1] for x in a], [x[1] for x in b])


def test_classifier_without_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    got = qc.classify(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    assert qc.classify(no_docs, labels).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=12))
def test_isotonic_is_monotone_and_fits(bins):
    total = np.array([max(a, b) for a, b in bins], float)
    good = np.array([min(a, b) for a, b in bins], float)
    if not total.sum():
        return
    level = qc.pool(total, good)
    assert (np.diff(level) >= -1e-12).all() and level.min() >= 0 and level.max() <= 1
    assert np.isclose((level * total).sum(), good.sum())
