import random

import numpy as np
import pytest
import tiktoken
from conftest_path import SF_SMALL

from permscope.llm import word_bpe
from permscope.llm.tokens import tokenizer_path, vocabularies
from permscope.llm.word_bpe import decode_ids, encode_texts, pre_token_pattern, read_ranks

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
PATTERN = vocabularies().PATTERN


@pytest.fixture(scope="module")
def whole():
    """The library itself, on whole texts."""
    with open(RANKS, "rb") as f:
        e = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    return lambda t: np.array(e.encode_ordinary(t or ""), "<u4").tobytes()


def run(docs):
    out = decode_ids(encode_texts(docs, RANKS, PATTERN), RANKS).collect()
    return sorted(((r.doc_id is not None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in out))


def expected(rows, whole):
    return sorted((i is not None, i or 0, whole(t), (t or "").encode()) for i, t in rows)


def test_odd_rows(odd_docs, odd_rows, no_docs, whole):
    assert run(odd_docs) == expected(odd_rows, whole)
    assert run(no_docs) == []


def test_small_chunks_and_pieces(odd_docs, odd_rows, whole, monkeypatch):
    monkeypatch.setattr(word_bpe, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(word_bpe, "PIECE_BYTES", 500)
    assert run(odd_docs) == expected(odd_rows, whole)


def test_any_characters(spark, whole, monkeypatch):
    monkeypatch.setattr(word_bpe, "PIECE_BYTES", 64)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", "　",
             "​", "'s", "'ll", "'", "''", "abc", "É", "é", "日本語", "😀", "12", "½", "!?", "...", "<|endoftext|>", "\0", "_"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))) for k in range(400)]
    rows += [(1000, "a" * 70_000), (1001, " " * 70_000 + "x"), (1002, "ab " * 50_000), (1003, "日" * 30_000 + " é"), (1004, "　 x" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == expected(rows, whole)


def test_white_space_is_unicodes():
    p = pre_token_pattern(r"\s+(?!\S)|[^\s\p{L}]+|\p{L}+")
    assert p.findall("a\x1cb\x85 c") == ["a", "\x1c", "b", "\x85", "c"] or p.findall("a\x1cb") == ["a", "\x1c", "b"]
    assert not pre_token_pattern(r"\s").match("\x1c") and pre_token_pattern(r"\s").match("\x85")


def test_query_equals_the_library(spark, whole):
    from brute import sha256
    from permscope.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_word_bpe"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = whole(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, sha256(ids), sha256(texts[r.doc_id] or ""))


def test_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, b""), (3, np.array([262, 1917], "<u4").tobytes())], "k int, ids binary")
    assert [r.decoded for r in decode_ids(rows, RANKS).orderBy("k").collect()] == [None, b"", decode(262) + decode(1917)]


def decode(i):
    with open(RANKS, "rb") as f:
        return {v: k for k, v in read_ranks(f.read()).items()}[i]
