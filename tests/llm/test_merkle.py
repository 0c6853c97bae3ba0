import pytest
from brute import sha256
from pyspark.sql import functions as F

from permscope.llm import merkle
from permscope.llm.merkle import folded, prove, siblings, write_manifest


def enc(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row):
    return sha256("".join(enc(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(nodes):
    """(root, proofs) of a list of digests."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(proofs):
            other = at[k] ^ 1
            if other < len(nodes):
                p.append(nodes[other])
            at[k] //= 2
        nodes = [sha256("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def manifest(rows):
    """{(doc_id, leaf): (subroot, root, siblings)} and the multiset of keys, by plain lists."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    subs, out = [], []
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        order = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, proofs = tree([leaf(r) for r in order])
        subs.append(root)
        out.append([(r["doc_id"], leaf(r), root, p) for r, p in zip(order, proofs)])
    if not subs:
        return []
    root, above = tree(subs)
    return sorted(((i, d, s, root, "".join(p + q)) for group, q in zip(out, above) for i, d, s, p in group),
                  key=lambda x: (x[0] is not None, x))


def answer(df):
    rows = df.select("id", "leaf", "subroot", "root", F.array_join(siblings(F.col("path")), "").alias("p")).collect()
    return sorted(map(tuple, rows), key=lambda x: (x[0] is not None, x))


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, "
                                       "grp string, rank string, path int, root int")


def some_rows(n, langs):
    return [{"doc_id": k, "source": f"s{k % 3}" if k % 5 else None, "lang": langs[k * k % len(langs)], "n_chars": k if k % 4 else None,
             "text": f"text é {k}" if k % 6 else ("" if k % 2 else None), "grp": "x", "rank": "y", "path": 1, "root": None}
            for k in range(n)]


@pytest.mark.parametrize("depth", [2, 8])
def test_proofs_equal_plain_trees(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)  # two levels a record: several records on a way
    rows = some_rows(75, ["en", "en", "en", None, "de", "z:1", "", "ü"])
    rows += [dict(rows[3]), dict(rows[3]), {**rows[4], "text": "other"}, {**rows[5], "doc_id": None}, {**rows[5], "doc_id": None}]
    rows += [{**rows[0], "lang": "one", "text": "long " * 200_000}]
    assert answer(prove(write_manifest(docs_of(spark, rows).repartition(7)))) == manifest(rows)


def test_small_tables(spark):
    assert answer(prove(write_manifest(docs_of(spark, [])))) == []
    for n in (1, 2, 3):
        rows = some_rows(n, ["en"])
        assert answer(prove(write_manifest(docs_of(spark, rows)))) == manifest(rows)


def test_tampering_shows(spark):
    rows = some_rows(40, ["en", "de", None])
    docs = docs_of(spark, rows)
    made = write_manifest(docs, claim={"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    out = prove(made).withColumn("again", folded(F.col("leaf"), F.col("path"))).withColumn("claimed_root", folded(F.col("claimed"), F.col("path")))
    for r in out.collect():
        assert r["again"] == r["root"] == made.root()
        changed = r["id"] % 3 == 0 and rows[r["id"]]["n_chars"] is not None
        assert (r["claimed_root"] == r["root"]) == (not changed)


def test_some_leaves_wanted(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 2)
    rows = some_rows(60, ["en", "de"])
    made = write_manifest(docs_of(spark, rows))
    wanted = spark.createDataFrame([("2:en", 0), ("2:en", 17), ("2:de", 29), ("2:de", 29), ("2:xx", 1), ("2:de", 500)], "grp string, rank long")
    got = prove(made, wanted)
    full = {(r["grp"], r["rank"]): r for r in prove(made).collect()}
    ask = {(r["grp"], r["rank"]) for r in wanted.collect()} & set(full)
    assert sorted((r["grp"], r["rank"], r["leaf"], r["path"]) for r in got.collect()) == sorted(
        (g, k, full[g, k]["leaf"], full[g, k]["path"]) for g, k in ask)
