import random

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

from permscope.llm import jaccard_join as jj
from permscope.llm.tables import components


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def result(docs, **kw):
    return order((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(docs, **kw).collect())


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_components_are_exact(odd_docs, odd_rows, n, percent):
    assert result(odd_docs, n=n, percent=percent) == order(jaccard(odd_rows, n, percent))


def test_chains_of_near_copies_and_far_ends(spark):
    """Links form long chains whose ends are not alike, beside families just below the threshold."""
    rng = random.Random(3)
    rows, k = [], 0
    for _ in range(4):
        w = [f"t{rng.randint(0, 5000)}" for _ in range(60)]
        for step in range(12):
            rows.append((k, " ".join(w)))
            k += 1
            w = list(w)
            w[(5 * step) % 60] = f"n{k}"
    base = [f"u{j}" for j in range(80)]
    for _ in range(40):
        w = list(base)
        for j in rng.sample(range(80), 4):
            w[j] = f"m{rng.randint(0, 10**6)}"
        rows.append((k, " ".join(w)))
        k += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, n=1, percent=85) == order(jaccard(rows, 1, 85))
    assert result(docs, n=2, percent=80) == order(jaccard(rows, 2, 80))


def test_groups_beyond_the_first_centres_go_on(spark, monkeypatch):
    """A star per signature alone would miss links: the blocks find them."""
    calls = []
    between = jj._between
    monkeypatch.setattr(jj, "BLOCK", 5)

    def counted(*a):
        out = between(*a)
        calls.append(out.count())
        return out

    monkeypatch.setattr(jj, "_between", counted)
    rng = random.Random(9)
    common = [f"c{j}" for j in range(70)]
    rows = []
    for f in range(12):  # families alike within, not across
        own = [f"f{f}_{j}" for j in range(16)]
        for m in range(3):
            w = common + own[:15] + [f"x{f}_{m}"]
            rng.shuffle(w)
            rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, n=1, percent=90) == order(jaccard(rows, 1, 90))
    assert len(calls) == 2


def test_empty_table(no_docs):
    assert jj.jaccard_components(no_docs).count() == 0
    assert jj.keep_one_of_each(no_docs).count() == 0


def test_one_row_of_each_group_stays(odd_docs, odd_rows):
    kept = jj.keep_one_of_each(odd_docs, n=5, percent=80)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    for _, t in rows:
        assert (None, t) in rows or any(t == x for _, x in odd_rows)
    worded = [(i, t) for i, t in rows if shingles(t, 5)]
    want = jaccard(odd_rows, 5, 80)
    groups = {c for (i, n, c), (_, t) in zip(want, odd_rows) if n}
    assert {i for i, _ in worded} >= {c for c in groups if c is not None}
    sets = [shingles(t, 5) for _, t in worded]
    for a in range(len(sets)):
        for b in range(a):
            assert 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b])
    assert sum(not shingles(t, 5) for _, t in rows) == sum(not shingles(t, 5) for _, t in odd_rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.integers(0, 8), st.randoms(use_true_random=False), st.sampled_from([60, 80, 85, 95]))
def test_linked_sets_share_a_signature(size, edits, rng, percent):
    """The pigeonhole holds for every allocation: deletions, slack and bands."""
    a = [f"t{rng.randint(0, 30)}" for _ in range(size)]
    b = list(a)
    for _ in range(edits):
        k = rng.randrange(len(b) + 1)
        if rng.random() < 0.5 and len(b) > 1:
            b.pop(min(k, len(b) - 1))
        else:
            b.insert(k, f"n{rng.randint(0, 99)}")
    sets = jj.token_sets(pa.array([" ".join(a), " ".join(b)]), 1)
    x, y = set(a), set(b)
    assert sets.sizes().tolist() == [len(x), len(y)]
    if 100 * len(x & y) < percent * len(x | y):
        return
    lower = jj.bands(percent, 200)
    for counts in ({}, {k: 10**7 for k in range(len(lower))}):
        plan = jj.allocate(percent, lower, counts)
        sig, row = jj.signatures(sets, plan)
        assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())


def test_allocation_uses_deletions_when_chance_pairs_cost_more():
    lower = jj.bands(85, 500)
    few, many = (jj.allocate(85, lower, {k: n for k in range(len(lower))}) for n in (10, 10**9))
    assert few.y.sum() < many.y.sum()
    units = few.m + few.y - few.c
    top = lower[1:] - 1
    assert (units[:-1] == 15 * 2 * top // 185).all()


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 160)]
    group = {}

    def find(x):
        group.setdefault(x, x)
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        group[b] = a
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: min(y for y in touched if find(y) == find(x)) for x in touched}


def test_edges_of_one_task_are_stars_at_once(spark, monkeypatch):
    from permscope.llm import tables

    made = []
    monkeypatch.setattr(tables, "stored", lambda df, name, f=tables.stored: made.append(name) or f(df, name))
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(7, 7), (300, 200), (200, 300)], "a long, b long")
    got = {r.node: r.comp for r in components(edges.coalesce(1)).collect()}
    assert got == {k: 0 for k in range(101)} | {200: 200, 300: 200}
    assert made == ["edges"]  # no round was needed


def test_edges_added_later_join_components(spark):
    from permscope.llm.tables import joined

    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(120)]
    more = [(rng.randint(0, 320), rng.randint(0, 320)) for _ in range(60)] + [(400, 401), (402, 402), (0, 400)]

    def of(rows):
        return spark.createDataFrame(rows, "a long, b long").repartition(3)

    def got(comp):
        return sorted((r.node, r.comp) for r in comp.collect())

    first = components(of(edges))
    want = got(components(of(edges + more)))
    assert got(joined(first, of(more))) == want
    assert joined(first, of(more).limit(0)) is first
    assert got(joined(components(of(edges).limit(0)), of(edges + more))) == want


def test_sketches_never_differ_more_than_the_sets():
    rng = random.Random(6)
    texts = []
    for n in (1, 30, 1000, 1024, 1025, 3000, 9000):
        w = [f"t{rng.randint(0, 10**6)}" for _ in range(n)]
        texts += [" ".join(w), " ".join(w[n // 9:]), " ".join(w[:n // 2] + [f"x{k}" for k in range(n // 3)])]
    sets = jj.token_sets(pa.array(texts), 1)
    sketch = jj.Sketches(jj.sketches(sets).to_pylist())
    assert {len(x) * 8 for x in jj.sketches(sets).to_pylist()} == {1024, 2048, 4096, 8192, 16384}
    x, y = (k.ravel() for k in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    got = jj.sketch_distance(sketch, x, sketch, y)
    each = [set(t.split()) for t in texts]
    want = np.array([len(each[i] ^ each[j]) for i, j in zip(x.tolist(), y.tolist())])
    assert (got <= want).all() and (got[x == y] == 0).all()
    far = want > 2000
    assert (got[far] > 400).all()
