"""The pipeline against a brute-force version of its stages, each on its own input."""

import brute
import corpus_pipeline as P
import pytest
from ledgerlens.llm import decontam
from ledgerlens.llm.staging import keep


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(keep(stage(spark, out[-1], sf_dir), "test-stage"))
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in P.STAGES] == ["language ID", "line dedup", "near-dedup", "decontamination", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:5])
    assert {r.doc_id for r in stages[5].select("doc_id").collect()} == set(_texts(stages[4]))


def test_language_keeps_clean_documents(stages):
    before, after = _texts(stages[0]), _texts(stages[1])
    assert set(after) == {d for d, t in before.items() if any(map(str.isalpha, t))}


def test_lines_are_kept_once(stages):
    before, after = _texts(stages[1]), _texts(stages[2])
    forms = [f for t in after.values() for f in map(brute.normal_line, t.split("\n")) if f]
    assert len(forms) == len(set(forms))
    for d, t in after.items():
        rest = iter(before[d].split("\n"))
        assert all(x in rest for x in t.split("\n"))


def test_one_document_of_each_group(stages):
    before, after = _texts(stages[2]), _texts(stages[3])
    assert set(after) == {d for d, (_, c) in brute.near_documents(before.items()).items() if d == c}
    assert all(before[d] == t for d, t in after.items())


def test_contaminated_documents_go(spark, sf_dir, stages):
    before, after = _texts(stages[3]), _texts(stages[4])
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after) == {d for d, v in brute.contamination(before.items(), items).items() if not v[4]}
    assert not any(r.contaminated for r in decontam.report(stages[4], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect())


def test_odd_rows_pass_through(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "Hello there, my good friend, how are you today?", "en", "s", 1), (2, "Hello there, my good friend, how are you today?", "en", "s", 1),
            (3, "Bonjour mes amis, comment allez vous ce soir ?", "fr", None, None), (4, "word " * 20_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in P.STAGES[:4]:
        docs = keep(stage(spark, docs, sf_dir), "test-odd")
    assert sorted(r.doc_id for r in docs.collect()) == [2, 3, 4]
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = keep(stage(spark, empty, sf_dir), "test-none")
    assert empty.count() == 0
