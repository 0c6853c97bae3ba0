"""Statistics of whole texts that the quality operators use, vectorised over a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from permscope.llm.substring_dedup import equal_windows
from permscope.llm.text import covered, ranges, raw_bytes, words_of

REPEAT_WINDOW = 8
STATISTICS_BYTES = 1 << 20  # text measured at a time: its arrays stay small enough for the processor's cache
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# ratios, so that the length of a clean text does not make it unusual
FEATURES = ["word_length", "symbols", "dup_lines", "repeat_words", "upper", "digits", "marks", "bang", "pipes",
            "distinct_words", "short_words", "long_words", "capital_words", "sentence_marks", "line_words", "odd_words"]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _class(b"#*$%&|<>")
_UPPER = _class(bytes(range(0x41, 0x5B)))
_DIGIT = _class(b"0123456789")
_MARK = _class(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_STOP = _class(b".,;:?!")


def statistics(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, features), one row per text; a text without words has zero features."""
    data, off = raw_bytes(col)
    n = len(off) - 1
    w = words_of(data, off)
    words = np.diff(w.doc)
    at = w.off[w.doc]  # words' bytes of each text (with one space a word)

    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flag))[at])

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flag))[w.off])

    point = (w.buf & 0xC0) != 0x80
    point[w.off[1:] - 1] = False  # the closing space
    chars = per_text(point)
    symbols = per_text(_SYMBOL[w.buf])

    # lines: every text closed by a line break
    closed = np.insert(data, off[1:], np.uint8(0x0A))
    end = np.flatnonzero(closed == 0x0A) + 1
    begin = np.append(0, end[:-1]) if len(end) else end
    line = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(end), [
        None, pa.py_buffer(np.append(0, end).astype(np.int64)), pa.py_buffer(closed)])
    which = line.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.searchsorted(off[1:] + np.arange(1, n + 1), begin, side="right")
    inside = w.begin + np.searchsorted(off[1:], w.begin, side="right")  # word starts within `closed`
    filled = np.searchsorted(inside, end) > np.searchsorted(inside, begin)
    lines = np.bincount(owner[filled], minlength=n)
    pair = np.unique((owner[filled] << 32) | which[filled])
    dup_lines = lines - np.bincount(pair >> 32, minlength=n)

    ids, distinct = w.ids()
    row = np.repeat(np.arange(n), words)
    count = np.maximum(words - REPEAT_WINDOW + 1, 0)
    first = ranges(w.doc[:-1], count)
    repeat = np.zeros(n, np.int64)
    if len(first):
        order, group = equal_windows((row << 32) | ids, first, REPEAT_WINDOW)
        again = first[order[np.bincount(group)[group] > 1]]
        repeat = np.diff(np.append(0, np.cumsum(covered(len(w), again, again + REPEAT_WINDOW)))[w.doc])

    base = np.column_stack([words, chars, symbols, dup_lines, repeat]).astype(np.int64)

    size = per_word(point)
    unlike = np.ones(len(w), bool)
    if len(w):
        pair = np.unique((row << 32) | ids)
        kinds = np.bincount(pair >> 32, minlength=n)
    else:
        kinds = np.zeros(n, np.int64)
    upper, marks = per_word(_UPPER[w.buf]), per_word(_MARK[w.buf])
    unlike = (upper > 1) | (marks > 2)
    bytes_ = np.maximum(np.diff(at), 1)
    some, long = np.maximum(words, 1), np.maximum(chars, 1)

    def share(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flag))[w.doc]) / some

    features = np.column_stack([
        chars / some / 10, symbols / long, dup_lines / np.maximum(lines, 1), repeat / some,
        per_text(_UPPER[w.buf]) / long, per_text(_DIGIT[w.buf]) / long, per_text(_MARK[w.buf]) / long,
        per_text(w.buf == 0x21) / long, per_text(w.buf == 0x7C) / bytes_ * 10,
        kinds / some * np.minimum(np.log1p(words), 10) / 10, share(size <= 2), share(size >= 10), share(_UPPER[w.buf[w.off[:-1]]] if len(w) else np.zeros(0, bool)),
        per_text(_STOP[w.buf]) / some, np.log1p(words / np.maximum(lines, 1)) / 5, share(unlike)])
    return base, np.where((words > 0)[:, None], features, 0.0)
