"""Token ids of whole texts with a public tokenizer, one encoding per distinct chunk of a batch.

Both supported tokenizer kinds (byte-level BPE whose pre-tokenizer attaches
white space to the next word, and BPE with word ends that drops white space)
never join text across the start of a white-space run.  A text is therefore
cut before each run of ASCII white space that follows a character which is
surely no white space, and the ids of a text are those of its chunks in order
(tests compare with encoding the whole text).  Both kinds also end a word before
a punctuation mark, so ``encode`` cuts between an ASCII letter and one of
``.,;:!?#$%&*")`` as well, which leaves fewer different chunks.  Equal chunks
of a batch are encoded once.
"""

from __future__ import annotations

import functools
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from permscope.llm.text import _SEPARATOR, ranges, raw_bytes


def vocabularies():
    """The module of public vocabularies (its ``path`` and ``PATTERN``)."""
    import importlib.util
    import sys

    if not importlib.util.find_spec("public_tokenizers"):  # the shared folder of public vocabularies
        spec = importlib.util.spec_from_file_location("public_tokenizers", "/opt/tokenizers/__init__.py")
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        sys.modules["public_tokenizers"] = module
    import public_tokenizers

    return public_tokenizers


def tokenizer_path(name: str) -> str:
    return str(vocabularies().path(name))


KNOWN_MAX = 350_000  # chunks whose ids a process remembers, twice: the newer ones, and those before (only speed depends on it)
_known: dict[str, tuple[dict[bytes, bytes], dict[bytes, bytes]]] = {}


@functools.lru_cache(maxsize=2)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each core has its task; the library would start threads for all in each
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b'.,;:!?#$%&*")')] = True  # none that stands after a letter in a special token


def cuts(data: np.ndarray, off: np.ndarray, marks: bool = False) -> np.ndarray:
    """Starts of the chunks (all row starts among them; a row without bytes has none).

    With ``marks`` a mark after an ASCII letter starts a chunk, too.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    white = _SEPARATOR[data]
    start = np.zeros(n, bool)
    start[1:] = white[1:] & ~white[:-1]
    b1 = data
    b2 = np.append(np.uint8(0), data[:-1])
    b3 = np.append(np.zeros(2, np.uint8), data[:-2]) if n > 2 else np.zeros(n, np.uint8)
    # the character before may be white space outside ASCII (or a control that some classes count as such)
    odd = (b1 < 0x20) | ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | (
        (b3 >= 0xE1) & (b3 <= 0xE3) & ((b2 == 0x9A) | (b2 == 0x80) | (b2 == 0x81)))
    start[1:] &= ~odd[:-1]
    if marks:
        start[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    begin = off[:-1][np.diff(off) > 0]
    start[begin] = True
    return np.flatnonzero(start)


@functools.lru_cache(maxsize=2)
def _edges(path: str) -> tuple[np.ndarray, bool]:
    """(per id: is it the edge of a word, is that edge the word's end): an end-of-word mark, or the space before."""
    tokenizer = load(path)
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    ends = np.array([x.endswith("</w>") for x in names])
    return (ends, True) if ends.any() else (np.array([x.startswith("\u0120") for x in names]), False)


def _ids_of(chunks: list[bytes], path: str) -> list[bytes]:
    """Ids of each chunk, as little-endian 32-bit integers.

    Chunks of one space and letters are one word each.  Many of them are
    encoded as one text, whose ids are cut at the words' edges again.  Each has
    one edge at least, so as many edges as chunks are one each (a letter that
    the library splits gives more; then fewer are encoded together, or one).
    """
    tokenizer, (edge, is_end) = load(path), _edges(path)
    out: list = [None] * len(chunks)
    texts = [c.decode() for c in chunks]
    plain = [k for k, t in enumerate(texts) if t[0] == " " and t[1:].isalpha()]
    for n in (1024, 32):
        left = []
        for i in range(0, len(plain), n):
            part = plain[i:i + n]
            found = tokenizer.encode_batch_fast(["".join([texts[k] for k in part])], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            cut = np.flatnonzero(edge[ids]) + is_end
            cut = np.append(0, cut) if is_end else np.append(cut, len(ids))
            if len(cut) == len(part) + 1 and cut[0] == 0 and cut[-1] == len(ids):
                raw, at = ids.tobytes(), (4 * cut).tolist()
                for k, a, b in zip(part, at, at[1:]):
                    out[k] = raw[a:b]
            else:
                left += part
        plain = left
    rest = [k for k, found in enumerate(out) if found is None]
    for i in range(0, len(rest), 4096):  # the library's encodings are large: few at a time
        part = rest[i:i + 4096]
        found = tokenizer.encode_batch_fast([texts[k] for k in part], add_special_tokens=False)
        for k, e in zip(part, found):
            out[k] = array("I", e.ids).tobytes()
    return out


def encode(col: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, offsets per row): ``tokenizers`` without special tokens, null as empty."""
    data, off = raw_bytes(col)
    begin = cuts(data, off, marks=True)
    if not len(begin):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    chunk = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = chunk.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    known, before = _known.setdefault(path, ({}, {}))
    texts = coded.dictionary.to_pylist()
    ids = list(map(known.get, texts))
    missing = [k for k, found in enumerate(ids) if found is None]
    if len(known) + len(missing) > KNOWN_MAX:
        _known[path] = known, before = {}, known
    new = []
    for k in missing:
        found = before.get(texts[k])
        if found is None:
            new.append(k)
        else:
            ids[k] = known[texts[k]] = found
    for k, found in zip(new, _ids_of([texts[k] for k in new], path)):
        ids[k] = known[texts[k]] = found
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.uint32)
    first = np.cumsum(size) - size
    out = flat[ranges(first[which], size[which])]
    total = np.append(0, np.cumsum(size[which]))
    return out, total[np.searchsorted(begin, off)]


def with_end(ids: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows, each closed by the id ``end``."""
    return np.insert(ids, off[1:], np.uint32(end)), off + np.arange(len(off))


def crc32s(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[int]:
    """Unsigned crc32 of each slice ``ids[first:last]`` as little-endian unsigned 32-bit integers."""
    import zlib

    raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
    for i, j in zip((first * 4).tolist(), (last * 4).tolist()):
        yield zlib.crc32(raw[i:j])
