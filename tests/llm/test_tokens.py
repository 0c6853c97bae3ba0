import numpy as np
import pyarrow as pa
import pytest
from brute import crc32_ids
from conftest_path import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from permscope.llm import packing, token_files
from permscope.llm import tokens as tk
from permscope.llm.queries import QUERIES
from permscope.llm.tables import scratch_path

KINDS = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def whole(name, texts):
    t = tk.load(tk.tokenizer_path(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def chunked(name, texts):
    ids, off = tk.encode(pa.array(texts, pa.string()), tk.tokenizer_path(name))
    return [ids[i:j].tolist() for i, j in zip(off[:-1], off[1:])]


@pytest.mark.parametrize("name", KINDS)
def test_chunks_give_the_ids_of_whole_texts(spark, name):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += [r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert chunked(name, texts) == whole(name, texts)


@pytest.mark.parametrize("name", KINDS)
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.none() | st.text(alphabet="aZé 1'st\n\t\x0b\x1c\x85\xa0　   ᠎​́Σ日<|endoftext|>!", max_size=30),
                      max_size=4))
def test_chunks_at_odd_white_space(name, texts):
    assert chunked(name, texts) == whole(name, texts)


@pytest.mark.parametrize("name", KINDS)
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="aZ 's\n#$%&*\")(<|>.-_é\u0301\u00adİßǰJ\u030cक़\u093f한ᄒ\u1161²٣", max_size=30)
                      | st.sampled_from(["a<|endoftext|>b", "it's#re 'll%", "x<|startoftext|>*"]), max_size=4))
def test_chunks_at_marks_and_letters_of_other_scripts(name, texts):
    tk._known.clear()  # nothing encoded before
    assert chunked(name, texts) == whole(name, texts)


class Counted:
    """A tokenizer that counts the texts it encodes."""

    def __init__(self, path):
        self.own, self.texts = tk.load(path), 0

    def __getattr__(self, name):
        return getattr(self.own, name)

    def encode(self, text, **kw):
        self.texts += 1
        return self.own.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **kw)


@pytest.mark.parametrize("name", KINDS)
def test_words_of_letters_are_encoded_together(name, monkeypatch):
    words = [f"{a}{b}{c}" for a in "éßüñо日aα" for b in "xйéab" for c in "çcšd"]
    texts = [" " + " ".join(words), " " + " ".join(f"ab{m} cd{m}{m}" for m in '#$%&*")')]
    want = whole(name, texts)
    counted = Counted(tk.tokenizer_path(name))
    tk._edges(tk.tokenizer_path(name))
    monkeypatch.setattr(tk, "load", lambda path: counted)
    tk._known.clear()
    assert chunked(name, texts) == want
    assert counted.texts <= 1 + 2 * 7  # the words in one text; each mark once alone and once doubled


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70000), st.integers(0, 2**32 - 1)), max_size=50))
def test_rank_coding_round_trip(ranks):
    r = np.array(ranks, np.uint32)
    control, data = token_files.pack_ranks(r)
    assert len(control) == -(-len(r) // 4)
    assert (token_files.unpack_ranks(control, data, len(r)) == r).all()


def test_token_files_round_trip(spark, odd_docs, odd_rows):
    path = scratch_path(spark, "tokens")
    made = token_files.write_token_files(odd_docs, path, tk.tokenizer_path(KINDS[0]), end_id=1, files=5)
    got = token_files.read_token_files(spark, path, made).orderBy("start").collect()
    ids = {(i, t): e + [1] for (i, t), e in zip(odd_rows, whole(KINDS[0], [t for _, t in odd_rows]))}
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array(ids[i, t], "<u4").tobytes() for i, t in odd_rows)


def test_token_files_of_an_empty_table(spark, no_docs):
    path = scratch_path(spark, "tokens")
    made = token_files.write_token_files(no_docs, path, tk.tokenizer_path(KINDS[0]), end_id=1)
    assert token_files.read_token_files(spark, path, made).count() == 0


def test_op3_query_equals_direct_encoding(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    want, at = [], 0
    for (i, _), e in zip(rows, whole(KINDS[0], [t for _, t in rows])):
        want.append((i, at, len(e) + 1, crc32_ids(e + [1])))
        at += len(e) + 1
    assert sorted(map(tuple, QUERIES["op3_token_files"](spark, SF_SMALL).collect())) == want


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=12))
def test_best_fit_plan(counts):
    plan = packing.best_fit_plan(counts, 32)
    placed, fill = {}, {}
    for length, lo, hi, first, each, at in plan:
        for rank in range(lo, hi):
            assert (length, rank) not in placed
            placed[length, rank] = True
            fill.setdefault(first + (rank - lo) // each, []).append((at + (rank - lo) % each * length, length))
    assert sorted(placed) == sorted((k, r) for k, n in counts.items() for r in range(n))
    for pieces in fill.values():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at <= 32
    # best fit takes the fullest sequence that fits, so no more than one document at a time would
    free = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [k for k, f in enumerate(free) if f >= length]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= length
        else:
            free.append(32 - length)
    assert len(fill) == len(free)


def check_packing(rows, got, capacity):
    by_doc = {}
    for (i, _), e in zip(rows, whole(KINDS[1], [t for _, t in rows])):
        e = e + [2]
        head = (len(e) - 1) % capacity + 1
        cuts = [0, *range(head, len(e) + 1, capacity)]
        by_doc.setdefault(i, []).extend((k, a, b - a, crc32_ids(e[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in by_doc.items()}
    seq = {}
    for r in got:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in seq.values():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at <= capacity
    return len(seq), sum(r.length for r in got)


def test_packing_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    path = tk.tokenizer_path(KINDS[1])
    for capacity in (64, 1024):
        got = packing.pack_best_fit(odd_docs, path, 2, capacity=capacity).collect()
        check_packing(odd_rows, got, capacity)
    assert packing.pack_best_fit(no_docs, path, 2).count() == 0


def test_op5_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n, total = check_packing(rows, QUERIES["op5_best_fit_packing"](spark, SF_SMALL).collect(), 1024)
    assert n <= 1.02 * -(-total // 1024) + 1
