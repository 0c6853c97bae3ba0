"""Operator 10: licence scan by sparse TF-IDF cosine, and inheritance along directories.

Document frequencies of all terms are counted over all texts: exactly for the
terms of the templates, in ``BUCKETS`` hashed counters for the others (two terms
that share a counter weigh as their sum, too little).  Every window of a text that
has as many words as a template, whatever the line breaks, is compared with it by
the cosine of TF-IDF vectors.  A template matches only a window that holds all its
naming terms (``NAMING``: the words and versions that tell licences apart), with no
other naming term among them.  Only windows with a naming term of the template, or
with a *telling* one where it has none, are scored: the terms left out are so light
that without a telling one no window can reach the threshold.  Of windows that
overlap, the one with the most matching weight counts.

A licence file of its directory is a text that is nearly all licence text (its
cosine, without copyright lines, to a full text of ``license_texts`` is
``FILE_THRESHOLD`` or more, or it is a notice and nothing else), or one that
holds a notice in a file called LICENSE, LICENCE, COPYING or NOTICE.  A notice in
prose licenses its own text alone.  Files without a
licence of their own take that of the nearest ancestor directory with a licence
file (the commonest licence there, then the first by name): directories are
joined with their ancestors, files with their directory.

Cases: null and empty texts have no licence of their own; a null path has no
directory and inherits nothing; rows that repeat a path are judged one by one;
ties between templates go to the first by name; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permscope.llm.tables import stored
from permscope.llm.text import Words, column_words, ranges, raw_bytes, text_batches, word_hashes, words_of

THRESHOLD = 0.6      # cosine of a segment
FILE_THRESHOLD = 0.8  # cosine of a whole text to a full licence text that makes it a licence file
PLACES = 2048        # compared at a time
TITLE = 12           # first words of a full text that may name it
BUCKETS = 1 << 20    # counters of the terms outside the templates

# The short notices by which licences ask to be applied.
_NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met",
                     "may be used to endorse or promote products derived from this software without specific prior written "
                     "permission"],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License",
                 "GNU Affero General Public License Version 3, 19 November 2007"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License"],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License"],
    "LGPL-3.0": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Names by which notices call a licence; each makes the usual short notices.
_CALLED = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"],
    "Apache-1.1": ["Apache License, Version 1.1"], "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0"],
    "Artistic-2.0": ["Artistic License 2.0"], "BSD-2-Clause": ["BSD 2-Clause License"], "BSD-3-Clause": ["BSD 3-Clause License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"], "CDDL-1.0": ["Common Development and Distribution License, Version 1.0"],
    "EPL-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License v2.0"],
    "EUPL-1.2": ["European Union Public Licence, Version 1.2"], "GPL": ["GNU General Public License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "ISC": ["ISC License"], "LGPL": ["GNU Lesser General Public License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"],
    "MIT": ["MIT License"], "MPL-1.1": ["Mozilla Public License, Version 1.1"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"], "Zlib": ["zlib License"],
    "CC0-1.0": ["Creative Commons CC0 1.0 Universal"],
}
_PARTS = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike",
          "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
          "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _templates() -> dict[str, list[str]]:
    out = {k: list(v) for k, v in _NOTICES.items()}
    for part, long in _PARTS.items():
        for version, scope in (("2.0", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            out[f"CC-{part}-{version}"] = [
                f"Licensed under CC {part} {version}.",
                f"This work is licensed under a Creative Commons {long} {version} {scope} License."]
    for name, called in _CALLED.items():
        out.setdefault(name, []).extend(f"{how} under the {c}." for c in called for how in ("Licensed", "Released", "Distributed"))
    for name, notices in out.items():
        notices.append(f"SPDX-License-Identifier: {name}")
    return {k: list(dict.fromkeys(v)) for k, v in out.items()}


TEMPLATES = _templates()
NAMING = {t.lower() for t in [
    *TEMPLATES, *(f"CC-{p}" for p in _PARTS), *_PARTS, *_PARTS.values(), "Affero", "Apache", "Artistic", "BSD", "2-Clause", "3-Clause",
    "Boost", "CC0", "Distribution", "Eclipse", "European", "GNU", "Lesser", "Mozilla", "zlib", "1.0", "1.1", "1.2", "2", "2.0", "2.1",
    "3", "3.0", "4.0", "v1.0", "v2.0", "v2.1", "v3.0"]}
RESERVED = {"all-rights-reserved": ["All rights reserved."]}  # listed among the notices, grants nothing
_NOTICE = pa.list_(pa.struct([("license", pa.string()), ("line", pa.int32()), ("score", pa.float64())]))
TEXTS = {p.stem: [p.read_text()] for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
_EDGE = " \t\r\n\v\f.,;:!?\"'()[]{}<>*/#-="


def _terms(words: pa.Array) -> pa.Array:
    return pc.ascii_trim(pc.ascii_lower(words.cast(pa.large_string())), _EDGE)


def _split(texts: list[str]) -> tuple[Words, list[str]]:
    w = words_of(*raw_bytes(pa.array(texts, pa.string())))
    return w, _terms(w.array()).to_pylist()


@dataclass
class Model:
    """Terms, their idf, unit template vectors (one row per notice) and the telling terms."""

    terms: list[str]
    idf: np.ndarray
    names: list[str]
    vectors: np.ndarray
    telling: np.ndarray
    lengths: np.ndarray       # words of each notice
    weights: np.ndarray       # norm of each notice
    full_names: list[str]
    full: np.ndarray          # unit vectors of the full texts
    full_telling: np.ndarray
    other: np.ndarray         # idf of the counters


def _no_copyright(w: Words, term: list[str], data: np.ndarray) -> np.ndarray:
    """True of words outside copyright lines ("Copyright (c) 2020 Name")."""
    line = np.searchsorted(np.flatnonzero(data == 0x0A), w.begin)
    line = line + np.repeat(np.arange(len(w.doc) - 1), np.diff(w.doc))
    mark = np.array([t == "copyright" for t in term], bool)
    after = np.array([t in ("c", "\u00a9") or t[:4].isdigit() for t in term[1:]] + [False], bool)
    return ~np.isin(line, line[mark & after])


def vocabulary(templates: dict[str, list[str]]) -> list[str]:
    return sorted({t for texts in templates.values() for t in _split(texts)[1] if t})


def _vectors(texts: dict[str, list[str]], terms: list[str], idf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(name, unit vector, words, norm) of each text."""
    at = {t: k for k, t in enumerate(terms)}
    names, rows, lengths, norms = [], [], [], []
    for name in sorted(texts):
        for text in texts[name]:
            w, words = _split([text])
            v = np.zeros(len(terms))
            for t, ok in zip(words, _no_copyright(w, words, raw_bytes(pa.array([text]))[0])):
                if t and ok:
                    v[at[t]] += 1
            lengths.append(int(v.sum()))
            v *= idf
            names.append(name)
            norms.append(np.linalg.norm(v))
            rows.append(v / norms[-1])
    return names, np.array(rows).reshape(len(rows), len(terms)), np.array(lengths), np.array(norms)


def _telling(vectors: np.ndarray, idf: np.ndarray, threshold: float) -> np.ndarray:
    """The rarest terms, until the rest of no vector can reach the threshold."""
    telling = np.zeros(len(idf), bool)
    rest = (vectors**2).sum(axis=1)
    for t in np.argsort(-idf, kind="stable"):
        if rest.max(initial=0) < (threshold - 1e-9) ** 2:
            break
        rest = rest - vectors[:, t] ** 2
        telling[t] = True
    return telling


def build(templates: dict[str, list[str]], terms: list[str], df: np.ndarray, n: int, threshold: float,
          texts: dict[str, list[str]] | None = None, other: np.ndarray | None = None) -> Model:
    idf = np.log((1 + n) / (1 + df)) + 1
    other = np.zeros(1) if other is None else other
    names, vectors, lengths, weights = _vectors(templates, terms, idf)
    full_names, full, *_ = _vectors(texts or {}, terms, idf)
    return Model(terms, idf, names, vectors, _telling(vectors, idf, threshold), lengths, weights,
                 full_names, full, _telling(full, idf, FILE_THRESHOLD),
                 (np.log((1 + n) / (1 + other)) + 1).astype(np.float32))


def _term_ids(w: Words, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(index of each word's term, its index in the batch's terms, these): -1 outside the templates, -2 for edge marks alone."""
    d = w.array().dictionary_encode()
    own = _terms(d.dictionary).dictionary_encode()
    at = pc.fill_null(pc.index_in(own.dictionary, terms), -1).to_numpy(zero_copy_only=False)
    at = np.where(pc.equal(pc.binary_length(own.dictionary), 0).to_numpy(zero_copy_only=False), -2, at)
    ident = own.indices.to_numpy(zero_copy_only=False)[d.indices.to_numpy(zero_copy_only=False)]
    return at[ident], ident, own.dictionary


def _bucket(terms: pa.Array, size: int) -> np.ndarray:
    """Counter of each term; 0 for the empty one."""
    w = column_words(terms)
    out = np.zeros(len(terms), np.int64)
    out[np.diff(w.doc) > 0] = (word_hashes(w) % np.uint64(size)).astype(np.int64)
    return out


def _weights(at: np.ndarray, ident: np.ndarray, terms: pa.Array, model: Model) -> np.ndarray:
    """idf of each word's term."""
    return np.where(at >= 0, model.idf[np.maximum(at, 0)], model.other[_bucket(terms, len(model.other))][ident])


def _frequencies(texts: DataFrame, terms: list[str]) -> tuple[np.ndarray, int, np.ndarray]:
    """(documents that hold each term, documents, documents by counter of the other terms): all rows."""
    size = len(terms) + BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = pa.array(terms, pa.large_string()), np.zeros(size + 1, np.int64)
        for b in text_batches(batches):
            w = words_of(*raw_bytes(b.column("text")))
            at, ident, own = _term_ids(w, known)
            row = np.repeat(np.arange(b.num_rows), np.diff(w.doc))
            slot = np.where(at >= 0, at, len(terms) + _bucket(own, BUCKETS)[ident])[at != -2]
            _, first = np.unique(row[at != -2] * max(len(own), 1) + ident[at != -2], return_index=True)  # a term once a document
            total += np.bincount(slot[first], minlength=size + 1)
            total[-1] += b.num_rows
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "n"])

    sums = texts.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)  # a fixed number of counters
    out[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    return out[:len(terms)], int(out[-1]), out[len(terms):-1]


def full_scores(col: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best cosine of the whole text to a full licence text, that text, first line with a word) of each text."""
    data, off = raw_bytes(col)
    n = len(off) - 1
    w = words_of(data, off)
    at, ident, terms = _term_ids(w, pa.array(model.terms, pa.large_string()))
    row = np.repeat(np.arange(n), np.diff(w.doc))
    best, text, where = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
    if not len(model.full):
        return best, text, where
    weight = _weights(at, ident, terms, model)
    some = np.unique(row[(at >= 0) & model.full_telling[np.maximum(at, 0)]])
    for r in some:
        a, b = int(w.doc[r]), int(w.doc[r + 1])
        t, i = at[a:b], ident[a:b]
        one = words_of(data[off[r]:off[r + 1]], np.array([0, off[r + 1] - off[r]]))
        keep = (t != -2) & _no_copyright(one, terms.take(pa.array(i)).to_pylist(), data[off[r]:off[r + 1]])
        _, first, tf = np.unique(i[keep], return_index=True, return_counts=True)
        t = t[keep][first]
        x = tf * weight[a:b][keep][first]
        cos = model.full[:, t[t >= 0]] @ x[t >= 0] / max(np.linalg.norm(x), 1e-12)
        k = int(cos.argmax())
        best[r], text[r], where[r] = cos[k], k, (data[off[r]:w.begin[a]] == 0x0A).sum()
    return best, text, where


@dataclass
class Found:
    """Matches of notices that do not overlap, by row and place."""

    row: np.ndarray
    notice: np.ndarray
    score: np.ndarray
    first: np.ndarray  # word of the row, words of edge marks alone not counted
    line: np.ndarray


def notices(col: pa.Array, model: Model, threshold: float = THRESHOLD) -> tuple[Found, np.ndarray]:
    """(matches, true for rows that are notices and nothing else)."""
    data, off = raw_bytes(col)
    n = len(off) - 1
    w = words_of(data, off)
    at, ident, own = _term_ids(w, pa.array(model.terms, pa.large_string()))
    real = np.flatnonzero(at != -2)
    square = _weights(at, ident, own, model)[real] ** 2
    row, at, ident = np.repeat(np.arange(n), np.diff(w.doc))[real], at[real], ident[real]
    doc = np.searchsorted(row, np.arange(n + 1))
    naming = pc.is_in(own, pa.array(sorted(NAMING), pa.large_string())).to_numpy(zero_copy_only=False)[ident]
    held = np.flatnonzero(at >= 0)
    held = held[np.argsort(at[held], kind="stable")]
    start = np.searchsorted(at[held], np.arange(len(model.terms) + 1))  # places of each term
    is_name = np.array([t in NAMING for t in model.terms])
    some = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for k, (v, size) in enumerate(zip(model.vectors, model.lengths)):
        names = np.flatnonzero((v > 0) & is_name)
        if len(names):  # all of them are in a match: the rarest here tells where
            t = names[np.argmin(start[names + 1] - start[names])]
            p = held[start[t]:start[t + 1]]
        else:
            p = np.sort(np.concatenate([held[start[t]:start[t + 1]] for t in np.flatnonzero((v > 0) & model.telling)] or [held[:0]]))
        for p in np.split(p, range(PLACES, len(p), PLACES)):
            low, high = doc[row[p]], doc[row[p] + 1]
            a = np.maximum(p - size + 1, low)
            near = np.unique(ranges(a, np.minimum(p + size, high) - a))
            a = np.unique(ranges(a, p + 1 - a))
            b = np.minimum(a + size, doc[row[a] + 1])
            i = np.searchsorted(near, a)
            j = i + b - a
            part = np.append(0, np.cumsum(np.where(at[near] >= 0, v[at[near]] * model.idf[at[near]], 0)))
            least = np.append(0, np.cumsum(square[near]))  # as if no term came twice: the cosine is at most
            ok = part[j] - part[i] >= (threshold - 1e-6) * np.sqrt(np.maximum(least[j] - least[i], 1e-12))
            a, b, dot = a[ok], b[ok], (part[j] - part[i])[ok]
            if not len(a):
                continue
            word = ranges(a, b - a)
            seg = np.repeat(np.arange(len(a)), b - a)
            _, first, tf = np.unique(seg * len(own) + ident[word], return_index=True, return_counts=True)
            cos = dot / np.sqrt(np.bincount(seg[first], tf**2 * square[word[first]], minlength=len(a)))
            ok = cos >= threshold - 1e-12
            if len(names):
                mine = np.isin(at[word], names)
                _, one = np.unique(seg[mine] * len(model.terms) + at[word[mine]], return_index=True)
                ok &= np.bincount(seg[mine][one], minlength=len(a)) == len(names)
                lo, hi = np.full(len(a), len(at)), np.full(len(a), -1)
                np.minimum.at(lo, seg[mine], word[mine])
                np.maximum.at(hi, seg[mine], word[mine])
                strange = naming[word] & ~mine & (word > lo[seg]) & (word < hi[seg])
                ok &= np.bincount(seg[strange], minlength=len(a)) == 0
            some.append((np.full(ok.sum(), k), a[ok], b[ok], cos[ok]))
    notice, a, b, cos = (np.concatenate(x) for x in zip(*some))
    order = np.lexsort((a, notice, -np.round(cos**2 * model.weights[notice], 9)))
    taken, exact, keep = np.zeros(len(at), bool), np.zeros(len(at), bool), []
    for h in order.tolist():
        if not taken[a[h]:b[h]].any():
            taken[a[h]:b[h]] = True
            exact[a[h]:b[h]] = cos[h] > 1 - 1e-6
            keep.append(h)
    keep = np.array(sorted(keep, key=lambda h: a[h]), np.int64)
    notice, a, cos = notice[keep], a[keep], np.minimum(cos[keep], 1.0)
    breaks = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(breaks, w.begin[real[a]]) - np.searchsorted(breaks, off[row[a]])
    bare = np.bincount(row[~exact], minlength=n) == 0
    return Found(row[a], notice, cos, a - doc[row[a]], line), bare & (np.diff(doc) > 0)


def _best(found: Found, n: int, only: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best, notice, where = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
    # equal scores: the first by name, then by place
    order = np.lexsort((found.first, found.notice, -np.round(found.score, 9), found.row))
    order = order[only[order]]
    rows, top = np.unique(found.row[order], return_index=True)
    top = order[top]
    best[rows], notice[rows], where[rows] = found.score[top], found.notice[top], found.line[top]
    return best, notice, where


def scores(col: pa.Array, model: Model, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best cosine of a window, its notice, its first line, whether the text is nothing but notices) of each text."""
    found, bare = notices(col, model, threshold)
    return (*_best(found, len(col), np.ones(len(found.row), bool)), bare)


def scan_licenses(files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, path, own_license, score, line, license_file, license, inherited_from, licenses, dir_licenses`` of every row.

    ``licenses`` are all matches in the text by place (a full licence text
    first), ``dir_licenses`` all licences of the nearest directory with a
    licence file, the commonest first; ``own_license`` and ``license`` are the
    best of them.
    """
    templates = templates or TEMPLATES | RESERVED
    texts = files.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), path.cast("string").alias("path"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    terms = vocabulary({"notices": sum(templates.values(), []), "texts": sum(TEXTS.values(), [])})
    df, n, other = _frequencies(texts, terms)
    model = build(templates, terms, df, n, threshold, TEXTS, other)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            found, whole = notices(b.column("text"), model, threshold)
            names = [model.names[k] for k in found.notice]
            best, notice, where = _best(found, b.num_rows, np.array([x not in RESERVED for x in names], bool))
            hit = notice >= 0
            name = [model.names[k] if ok else None for k, ok in zip(notice.tolist(), hit.tolist())]
            every = [[] for _ in range(b.num_rows)]
            for r, *x in zip(found.row.tolist(), names, found.line.tolist(), found.score.tolist()):
                every[r].append(tuple(x))
            like, text, first = full_scores(b.column("text"), model)
            for r in np.flatnonzero(like >= FILE_THRESHOLD):  # the licence of a full text goes before the notices in it
                full = model.full_names[text[r]]
                for k in np.flatnonzero((found.row == r) & (found.first < TITLE)):
                    # the title of a licence whose full text is not here, close to one that is (AGPL)
                    if names[k] not in RESERVED and names[k] not in model.full_names and not full.startswith(names[k]):
                        full = names[k]
                hit[r], best[r], name[r], where[r] = True, min(like[r], 1.0), full, first[r]
                every[r].insert(0, (full, int(first[r]), float(best[r])))
            whole = whole | (like >= FILE_THRESHOLD)
            yield pa.record_batch([b.column("doc_id"), b.column("path"), pa.array(name, pa.string()),
                                   pa.array(np.where(hit, np.minimum(best, 1.0), 0.0)), pa.array(where.astype(np.int32), mask=~hit),
                                   pa.array(whole, pa.bool_()), pa.array(like >= FILE_THRESHOLD), pa.array(every, _NOTICE)],
                                  names=["doc_id", "path", "own_license", "score", "line", "whole", "full", "licenses"])

    own = stored(texts.mapInArrow(scan, "doc_id long, path string, own_license string, score double, line int, whole boolean, full boolean, "
                                         "licenses array<struct<license string, line int, score double>>"), "licenses")
    base = F.upper(F.element_at(F.split("path", "/"), -1))
    own = own.withColumn("license_file", F.col("own_license").isNotNull() & F.coalesce(
        F.col("whole") | base.rlike(r"^(LICEN[SC]E|COPYING|NOTICE)([.-].*)?$"), F.lit(False)))
    # "" is the root directory of a relative path
    own = own.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).otherwise(
        F.when(F.col("path").isNotNull(), F.lit(""))))
    # each licence of each licence file; a full text speaks for itself, not the notices in it
    held = own.where("license_file and dir is not null").withColumn("l", F.explode(F.when(
        F.col("full"), F.array("own_license")).otherwise(F.array_distinct(F.transform("licenses", lambda x: x["license"]))))).where(
        ~F.col("l").isin(list(RESERVED))).groupBy("dir", "l").agg(
        F.count("*").alias("n"), F.sum((F.col("l") == F.col("own_license")).cast("int")).alias("best"))
    held = held.groupBy(F.col("dir").alias("ancestor")).agg(F.transform(F.array_sort(F.collect_list(  # as many as there are licences
        F.struct((-F.col("best")).alias("best"), (-F.col("n")).alias("n"), "l"))), lambda x: x["l"]).alias("dir_licenses"))
    parts = F.split("dir", "/")
    dirs = own.where("dir is not null").select("dir").distinct().select(
        "dir", F.explode(F.array_union(F.array(F.lit("")), F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))).alias("ancestor"))
    nearest = dirs.join(held, "ancestor").groupBy("dir").agg(
        F.max_by(F.struct("ancestor", "dir_licenses"), F.length("ancestor")).alias("near"))
    out = own.join(nearest, "dir", "left")
    mine = F.col("own_license").isNotNull()
    return out.select("doc_id", "path", "own_license", "score", "line", "license_file",
                      F.coalesce("own_license", F.col("near.dir_licenses")[0]).alias("license"),
                      F.when(~mine, F.col("near.ancestor")).alias("inherited_from"), "licenses",
                      F.col("near.dir_licenses").alias("dir_licenses"))
