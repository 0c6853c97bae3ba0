import corpus_pipeline as pipe
import pytest
from brute import base_counts, holds, shingles, substring_dedup
from conftest_path import SF_SMALL

from permscope.llm.tables import stored


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in pipe.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(steps):
    assert [k for k, _ in pipe.STAGES] == ["quality_rules", "jaccard_join", "substring_dedup", "decontamination", "best_fit_packing"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_quality_stage(spark, steps):
    before, after = texts(steps[0]), texts(steps[1])
    failed = {i for i, t in before.items() for n, _, _, _, r in [base_counts(t)] if n < 20 or 100 * r > 30 * n}
    assert not failed & set(after)
    assert all(after[i] == before[i] for i in after)
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()} - failed
    assert len(good & set(after)) >= 0.98 * len(good)


def test_jaccard_stage(steps):
    before, after = texts(steps[1]), texts(steps[2])
    sets = {i: shingles(t, 5) for i, t in before.items()}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ids = sorted(before)
    for a in after:
        assert not any(b != a and alike(a, b) for b in after)
    for a in ids:
        if a not in after:
            assert any(b < a and b != a for b in ids if alike(a, b)) or any(alike(a, b) for b in ids if b != a)


def test_substring_stage(steps):
    before, after = texts(steps[2]), {r.doc_id: r for r in steps[3].collect()}
    for i, _, gone, kept in substring_dedup(sorted(before.items())):
        if gone and not kept:
            assert i not in after
        else:
            assert after[i].text == (kept if gone else before[i])
            if gone:
                assert after[i].n_chars == len(kept)


def test_decontamination_stage(spark, steps):
    before, after = texts(steps[3]), texts(steps[4])
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert after == {i: t for i, t in before.items() if not any(holds(t, x) for x in items)}


def test_packing_stage(steps):
    assert {r.doc_id for r in steps[5].select("doc_id").collect()} == set(texts(steps[4]))


def test_run_equals_the_stages(spark, steps):
    key = lambda r: (r.doc_id, r.piece)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(pipe.run(spark, SF_SMALL).select(cols).collect(), key=key)
    assert got == sorted(steps[5].select(cols).collect(), key=key)


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        one = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in pipe.STAGES:
            out = stored(stage(spark, one, SF_SMALL), name)
            if name != "best_fit_packing":
                assert out.columns == one.columns
                assert out.count() <= one.count()
