import numpy as np
import pyarrow as pa
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

from permscope.llm import superkmers as sk
from permscope.llm import text as tx
from permscope.llm.substring_dedup import equal_windows
from permscope.llm.suffix_dedup import equal_strings

texts = st.lists(st.none() | st.text(alphabet="ab \n\t\x0b\x1cé日 ", max_size=40), max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_equal_the_pattern(rows):
    w = tx.column_words(pa.array(rows, pa.string()))
    all_words = [x.decode()[:-1] for x in w.array().to_pylist()]
    assert [all_words[i:j] for i, j in zip(w.doc[:-1], w.doc[1:])] == [words(t) for t in rows]
    again = tx.packed_words(w.buf, w.off[w.doc])
    assert (again.off == w.off).all() and (again.doc == w.doc).all()
    h = dict()
    for x, v in zip(all_words, tx.word_hashes(w).tolist()):
        assert h.setdefault(x, v) == v
    assert len(set(h.values())) == len(h)


def test_long_words_hash_all_bytes():
    w = tx.column_words(pa.array(["x" * 1000 + "a", "x" * 1000 + "b", "x" * 1000 + "a"]))
    h = tx.word_hashes(w)
    assert h[0] == h[2] != h[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 13))
def test_rolling_depends_on_the_units_alone(units, width):
    u = np.array(units, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)
    h = tx.rolling(u, width)
    assert len(h) == max(0, len(units) - width + 1)
    seen = {}
    for k in range(len(h)):
        assert seen.setdefault(tuple(units[k:k + width]), h[k]) == h[k]
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=13, max_size=60), st.integers(1, 13))
def test_equal_windows_and_strings(units, window):
    ids = np.array(units, np.int64)
    at = np.arange(len(ids) - window + 1)
    for order, group in (equal_windows(ids, at, window), equal_strings(ids.astype(np.uint8), at, window)):
        got = {}
        for k, g in zip(order.tolist(), group.tolist()):
            got.setdefault(g, set()).add(tuple(units[k:k + window]))
        assert all(len(v) == 1 for v in got.values())
        assert len(got) == len({tuple(units[k:k + window]) for k in at})


def test_colliding_hashes_are_told_apart(monkeypatch):
    import permscope.llm.substring_dedup as sd
    import permscope.llm.suffix_dedup as sx

    ids = np.array([1, 2, 1, 2, 3, 1, 2], np.int64)
    at = np.arange(6)
    for module, f, x in ((sd, sd.equal_windows, ids), (sx, sx.equal_strings, ids.astype(np.uint8))):
        monkeypatch.setattr(module, "mix", lambda v: v * np.uint64(0))  # every hash is the same
        order, group = f(x, at, 2)
        got = {}
        for k, g in zip(order.tolist(), group.tolist()):
            got.setdefault(g, set()).add(tuple(ids[k:k + 2].tolist()))
        assert all(len(v) == 1 for v in got.values())
        assert len(got) == 4


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5), st.integers(2, 12), st.integers(1, 5))
def test_superkmers_hold_every_window_once(rows, window, m):
    m = min(m, window)
    data, off = tx.raw_bytes(pa.array(rows, pa.string()))
    u = sk.Units(data, None, off, tx.byte_codes(data), len(data))
    first, count, mini, place = sk.runs(u, window, m, anchors=True)
    got = sorted(k for f, c in zip(first.tolist(), count.tolist()) for k in range(f, f + c))
    assert got == sorted(k for i, j in zip(off[:-1].tolist(), off[1:].tolist()) for k in range(i, j - window + 1))
    # equal windows lie in super-k-mers of one minimiser, and unmarked ones hold no window twice
    key = {}
    raw = data.tobytes()
    for f, c, v, p in zip(first.tolist(), count.tolist(), mini.tolist(), place.tolist()):
        inside = [raw[k:k + window] for k in range(f, f + c)]
        for s in inside:
            assert key.setdefault(s, v) == v
        assert p < 0 or len(set(inside)) == len(inside)


def test_text_batches_bound_bytes_and_keep_rows():
    b = pa.record_batch([pa.array(["a" * 50, None, "b" * 200, "", "c" * 50])], names=["text"])
    got = list(tx.text_batches([b], limit=100))
    assert [x for g in got for x in g.column("text").to_pylist()] == b.column("text").to_pylist()
    assert [g.num_rows for g in got] == [2, 1, 2] or sum(g.num_rows for g in got) == 5
