import random

import pytest


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    from permscope.session import let_workers_import

    let_workers_import(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): copies, shared passages, nulls, empty, long and repetitive texts, repeated rows."""
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(400)] + ["The", "the", "é́", "日本", "a.b", "#x", "naïve"]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    base, passage = prose(90), prose(40)
    rows = [(k, prose(rng.randint(0, 120))) for k in range(0, 40)]
    rows += [(100 + k, base) for k in range(25)]                                   # a third exact copies
    rows += [(200 + k, base.replace(f" w{k}", f" v{k}", 1)) for k in range(10)]     # near copies
    rows += [(300 + k, prose(20) + "\n" + passage + "\t" + prose(15)) for k in range(10)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "a " * 300), (405, "ab" * 400),
             (406, prose(3000) + " " + passage), (407, (passage + "\n") * 4), (408, "x" * 99), (409, "x" * 100)]
    rows += [(410, passage), (410, passage), (410, prose(30)), (None, base), (None, None), (50, base), (0, base)]
    rows += [(411, base.upper()), (412, " " + base), (413, "x" * 101 + "y" * 100)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with other columns whose names clash with the operators' own."""
    rows = [(i, t, "en", f"s{k}", k, "x", 1) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "row string, fp int").repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
