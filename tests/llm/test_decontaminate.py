import itertools
import random

import pytest
from brute import holds
from conftest_path import SF_SMALL

from permscope.llm import decontaminate as dc
from permscope.llm.queries import QUERIES


def test_masks_miss_no_window():
    """Wherever two of thirteen words differ, a mask placement avoids both."""
    for a, b in itertools.combinations(range(dc.WINDOW), 2):
        assert any(a - o not in m and b - o not in m for m in dc.MASKS for o in range(dc.WINDOW - m[-1]))
    assert all(m[-1] + 1 <= 9 for m in dc.MASKS) and dc.MASKS[0][-1] + 1 == dc.SHORTEST


@pytest.fixture(scope="module")
def case(spark, odd_rows):
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(60)] + ["The", "x"]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(prose(n))) for k, n in enumerate([30, 13, 14, 50, 12, 8, 9, 7, 1, 0, 25, 25])]
    items += [(50, items[0][1]), (None, items[3][1]), (51, None), (52, items[10][1].upper())]
    rows = list(odd_rows)
    for k in range(150):
        w = prose(30)
        text = rng.choice(items[:12])[1].split()
        if text and k % 5:
            i = rng.randrange(len(text))
            part = text[i // 2:] if k % 3 else list(text)
            for _ in range(k % 4):
                part[rng.randrange(len(part))] = "zz"
            w[10:10] = part
        rows.append((1000 + k, " ".join(w)))
    docs = spark.createDataFrame([(i, t, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, item_id string, n_words int")
    return rows, items, docs.repartition(4), spark.createDataFrame(items, "item_id long, text string")


def found(rows, items):
    out = []
    for i, t in rows:
        mine = {}
        for k, x in items:
            if x is not None and holds(t, x):
                mine[x] = min(mine.get(x, k) if mine.get(x, k) is not None else k, k) if k is not None else mine.get(x)
        if mine:
            out.append((i, len(mine)))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def test_overlaps_equal_brute_force(case):
    rows, items, docs, bench = case
    got = dc.find_overlaps(docs, bench).collect()
    distinct = {}
    for i, t in rows:
        distinct[i, t] = t
    want = found([k for k in distinct], items)
    assert sorted(((r.doc_id, r.n_items) for r in got), key=lambda r: (r[0] is not None, r)) == want
    assert all(r.n_equal <= r.n_words and r.first_word >= 0 for r in got)


def test_every_overlap_and_short_items(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(20)) for x in "ab")
    items = [(1, a), (2, b), (3, "Four short plain words"), (4, "answer"), (5, "日本語の問題"), (6, "猫")]
    docs = [(1, f"x {a} y z {b} x {a}"), (2, "say FOUR short plain words and four short plain words"), (3, "answers are not the answer"),
            (4, "これは日本語の問題です"), (5, "four short plain"), (6, "答え 猫が"), (7, None), (8, "猫"), (9, "Answer")]
    got = dc.every_overlap(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                           spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.n_words) for r in got) == [
        (1, 1, 1, 20), (1, 1, 44, 20), (1, 2, 23, 20), (2, 3, 1, 4), (2, 3, 6, 4), (3, 4, 4, 1), (4, 5, 0, 1), (6, 6, 1, 1), (8, 6, 0, 1),
        (9, 4, 0, 1)]


def test_items_of_every_length(spark):
    """Items of 1 to 12 words through the query's operator: whole, anywhere, in any case; near misses are clean."""
    words = [f"k{k}" for k in range(12)]
    items = [(n, " ".join(f"{w}x{n}" for w in words[:n])) for n in range(1, 13)] + [(20, "日本語"), (21, " \t")]
    docs = [(n, f"some words before {t.upper() if n % 2 else t} and after") for n, t in items if n < 20]
    docs += [(100 + n, "start " + " ".join(t.split()[:-1]) + " end") for n, t in items if 1 < n < 20]
    docs += [(200, "これは日本語です"), (201, "これは日本です"), (202, None)]
    got = dc.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(n, n) for n in range(1, 13)] + [(200, 20)]


def test_a_full_bitmap_changes_nothing(case, monkeypatch):
    import numpy as np

    _, _, docs, bench = case
    want = sorted(map(str, dc.find_overlaps(docs, bench).collect()))
    monkeypatch.setattr(dc, "_bitmap", lambda items, seeds=None: np.full(dc.BITS // 8, 255, np.uint8))
    assert sorted(map(str, dc.find_overlaps(docs, bench).collect())) == want


def test_removal_keeps_clean_rows_as_they_are(case):
    rows, items, docs, bench = case
    got = dc.remove_contaminated(docs, bench)
    assert got.columns == docs.columns
    want = [(i, t) for i, t in rows if not any(holds(t, x) for _, x in items)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)


def test_empty_tables(case):
    _, _, docs, bench = case
    assert dc.find_overlaps(docs.limit(0), bench).count() == 0
    assert dc.find_overlaps(docs, bench.limit(0)).count() == 0
    assert dc.remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_op7_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = QUERIES["op7_decontamination"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.n_items) for r in got) == found(rows, items)
    assert all(r.contaminated for r in got)
