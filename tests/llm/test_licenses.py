import numpy as np
import pyarrow as pa
from conftest_path import SF_SMALL
from pyspark.sql import functions as F

from permscope.llm import licenses as lc
from permscope.llm.queries import QUERIES

APACHE, MIT = lc.TEMPLATES["Apache-2.0"][0], lc.TEMPLATES["MIT"][0]


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3)
    return {r.doc_id: r for r in lc.scan_licenses(df, F.col("path")).collect()}


def test_headers_files_and_nearest_ancestor(spark):
    prose = "some words of a text that has nothing to do with it at all and goes on for a while\n"
    got = scan(spark, [
        (1, "a/LICENSE", prose * 20 + MIT + "\n" + prose), (2, "a/x.py", prose), (3, "a/b/y.py", prose),
        (4, "a/b/c/COPYING", APACHE), (5, "a/b/c/z.py", prose), (6, "a/b/c/d/e/w.py", prose), (7, "a/b/c/v.py", MIT + "\n" + prose * 20),
        (8, "q/u.py", prose), (9, "top.py", prose), (10, None, prose), (11, None, APACHE), (12, "a/b/n", None), (13, "ab/n", ""),
        (14, "a/b/m.py", "# Licensed under the Apache License,\n# Version 2.0.\n" + prose * 20)])
    assert {k: (r.license, r.inherited_from) for k, r in got.items()} == {
        1: ("MIT", None), 2: ("MIT", "a"), 3: ("MIT", "a"), 4: ("Apache-2.0", None), 5: ("Apache-2.0", "a/b/c"),
        6: ("Apache-2.0", "a/b/c"), 7: ("MIT", None), 8: (None, None), 9: (None, None), 10: (None, None),
        11: ("Apache-2.0", None), 12: ("MIT", "a"), 13: (None, None), 14: ("Apache-2.0", None)}
    assert got[1].license_file and got[4].license_file and got[11].license_file and not got[7].license_file
    assert got[7].line == 0 and got[1].line == 20 and got[2].line is None


def test_a_note_with_a_notice_licenses_nothing_but_itself(spark):
    got = scan(spark, [(1, "a/note", "Seven words of a short prose note.\n" + MIT), (2, "a/x", "other text"), (3, "a/b/y", "more"),
                       *((k, f"c/{k}", "words that many other texts have, of a note") for k in range(10, 30))])
    assert (got[1].own_license, got[1].license_file) == ("MIT", False)
    assert [got[k].license for k in (2, 3)] == [None, None]


def test_full_licence_texts_are_licence_files_whatever_their_name(spark):
    rows = [(k, f"d{k}/x{k}", "Copyright (c) 2019 Some Unheard Name Ltd.\n\n" + t[0]) for k, t in enumerate(lc.TEXTS.values())]
    got = scan(spark, rows + [(100 + k, f"d{k}/e/f", "text") for k in range(len(rows))])
    assert all(got[k].license_file and got[100 + k].license == name and got[k].own_license == name for k, name in enumerate(lc.TEXTS))


def test_near_names_are_told_apart(spark):
    want = {"Released under the ISC License.": "ISC", "Released under the XYZ Commercial License.": None,
            "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0", "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
            "Licensed under CC BY 4.0.": "CC-BY-4.0",
            "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
            "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
            "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
            "Licensed under the Eclipse Public License, Version 2.0.": "EPL-2.0", "Released under the MIT License.": "MIT",
            "Released under the NIT License.": None}
    prose = [(100 + k, f"p{k}", "the work is under a version of the text and licensed words") for k in range(40)]
    got = scan(spark, [(k, f"d{k}/f", f"Some prose.\n{t}\nMore.") for k, t in enumerate(want)] + prose)
    assert {t: got[k].own_license for k, t in enumerate(want)} == want


def test_notices_inside_long_lines_and_over_many_short_ones(spark):
    prose = " ".join(f"word{k}" for k in range(300))
    want = {f"{prose} Released under the MIT License. {prose}": "MIT", f"{prose} Licensed under CC BY-NC 4.0. {prose}": "CC-BY-NC-4.0",
            f"{prose} {APACHE} {prose}": "Apache-2.0", f"{prose} {lc.TEMPLATES['GPL-3.0'][0]} {prose}": "GPL-3.0",
            "# " + "\n# ".join(lc.TEMPLATES["GPL-3.0"][1].split()) + "\n" + prose: "GPL-3.0", f"{prose}\n{prose}": None}
    got = scan(spark, [(k, f"d{k}/f", t) for k, t in enumerate(want)])
    assert [got[k].own_license for k in range(len(want))] == list(want.values())
    assert got[0].line == 0 and got[4].line == 0 and got[0].score > 0.99


def test_all_notices_and_all_licences_of_a_directory(spark):
    prose = " ".join(f"word{k}" for k in range(50))
    agpl = lc.TEXTS["GPL-3.0"][0].replace("GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007",
                                          "GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007")
    got = scan(spark, [(1, "a/x.py", f"{prose}\n{MIT}\n{prose} {APACHE}\n{prose}\nAll rights reserved."), (2, "b/LICENSE-MIT", lc.TEXTS["MIT"][0]),
                       (3, "b/LICENSE-APACHE", lc.TEXTS["Apache-2.0"][0]), (4, "b/c/y", prose), (5, "b/COPYING", lc.TEXTS["MIT"][0]),
                       (6, "d/NOTICE", f"{MIT}\n{prose}\n{APACHE}"), (7, "d/z", prose), (8, "e/f", f"{prose}\nAll rights reserved."),
                       (9, "g/h", agpl), (10, "i/j", lc.TEXTS["GPL-3.0"][0])])
    assert [(x.license, x.line) for x in got[1].licenses] == [("MIT", 1), ("Apache-2.0", 2), ("all-rights-reserved", 4)]
    assert got[1].own_license == "Apache-2.0" and not got[1].license_file
    assert got[4].dir_licenses == ["MIT", "Apache-2.0"] and got[4].license == "MIT"
    assert sorted(got[7].dir_licenses) == ["Apache-2.0", "MIT"] and got[4].licenses == []
    assert [x.license for x in got[8].licenses] == ["all-rights-reserved"] and got[8].own_license is None
    assert got[9].own_license == "AGPL-3.0" and got[10].own_license == "GPL-3.0"


def test_frequencies_of_all_terms(spark):
    df = spark.createDataFrame([(t,) for t in ["a rare word", "a word, a Word", "a", None, ""]], "text string")
    known, n, other = lc._frequencies(df.repartition(3), ["a"])
    at = lc._bucket(pa.array(["word", "rare", "none"]), lc.BUCKETS)
    assert (known.tolist(), n, other[at].tolist(), other.sum()) == ([3], 5, [2, 1, 0], 3)


def test_a_licence_at_the_root_reaches_all(spark):
    got = scan(spark, [(1, "LICENSE", MIT), (2, "a/b", "text"), (3, "c", "text"), (4, None, "text")])
    assert [got[k].license for k in (1, 2, 3, 4)] == ["MIT", "MIT", "MIT", None]


def test_every_template_finds_itself(spark):
    rows = [(k, f"d{k}/f", f"before\n{t}\nafter") for k, t in enumerate(t for v in lc.TEMPLATES.values() for t in v)]
    names = [n for n, v in lc.TEMPLATES.items() for _ in v]
    got = scan(spark, rows)
    assert [got[k].own_license for k in range(len(rows))] == names


def test_telling_terms_lose_no_segment():
    """Scoring every line gives the same licences as scoring lines with a telling term."""
    terms = lc.vocabulary(lc.TEMPLATES)
    rng = np.random.default_rng(4)
    model = lc.build(lc.TEMPLATES, terms, rng.integers(0, 1000, len(terms)), 1000, lc.THRESHOLD)
    assert 0 < model.telling.sum() < len(terms)
    texts = [" ".join(rng.choice(terms, rng.integers(1, 14))) + "\n" + " ".join(rng.choice(terms + ["zz"] * 40, 9)) for _ in range(300)]
    col = pa.array(texts + [None, ""])
    some = lc.scores(col, model)
    model.telling[:] = True
    all_ = lc.scores(col, model)
    hit = all_[0] >= lc.THRESHOLD
    assert ((some[0] >= lc.THRESHOLD) == hit).all()
    assert np.allclose(some[0][hit], all_[0][hit])


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a/f", MIT), (1, "a/f", MIT), (None, "a/g", "x")], "doc_id long, path string, text string")
    got = lc.scan_licenses(df, F.col("path")).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (1, "MIT"), (1, "MIT")]
    assert lc.scan_licenses(df.limit(0), F.col("path")).count() == 0


def test_op10_query(spark):
    got = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, SF_SMALL).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    marks = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": lc.TEMPLATES["GPL-3.0"][0], "Apache-2.0": APACHE, "MIT": MIT}
    assert set(got) == set(docs)
    for i, d in docs.items():
        own = [k for k, t in marks.items() if t in (d.text or "")]
        assert [got[i].own_license] == (own or [None])
    held = {}
    for r in got.values():
        if r.license_file:
            held.setdefault(r.path.rsplit("/", 1)[0], []).append(r.own_license)
    for r in got.values():
        parent = r.path.rsplit("/", 1)[0]
        if r.own_license is None:
            want = held.get(parent)
            assert (r.license in want if want else r.license is None) and r.inherited_from == (parent if want else None)
