import brute
import pytest
from ledgerlens.llm import decontam, registry

SCHEMA = "doc_id bigint, text string, item string, _text string, c0 int"


def _rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


@pytest.fixture(scope="module")
def cases(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, ten.upper() + " eleven"), (2, None), (3, ""), (4, "..."), (5, f"x {ten} y {ten} z"), (6, "short item here"), (7, "a short, ITEM! here"),
            (8, "one two three four five six seven eight nine"), (9, "word " * 30000 + ten), (5, f"x {ten} y {ten} z"), (10, "größer ÄÖ 東京 x")]
    items = [(1, ten), (2, "zero " + ten), (3, "short item"), (None, "short item here"), (4, None), (5, ""), (1, ten), (6, "größer ÄÖ")]
    return (spark.createDataFrame([(d, t, "x", "y", 1) for d, t in docs], SCHEMA), spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, doc_id string"), docs, items)


def test_report_equals_brute_force(cases):
    docs, items, d, b = cases
    assert _rows(decontam.report(docs, items)) == brute.contamination(d, b)


def test_small_blocks_give_the_same(cases):
    docs, items, d, b = cases
    assert _rows(decontam.report(docs, items, block=2)) == brute.contamination(d, b)


def test_query_on_whole_table(spark, sf_dir):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(*(["doc_id", "text"] if t == "documents" else ["item_id", "text"])).collect()]
    assert _rows(registry.op1_decontamination(spark, sf_dir)) == brute.contamination(read("documents"), read("benchmark"))


def test_oracle_sql(spark, sf_dir, duck):
    want = duck.execute(registry.oracle_sql()["op1_decontamination"]).fetchall()
    got = registry.op1_decontamination(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_removing_documents_and_spans(cases):
    docs, items, d, b = cases
    bad = {k for k, v in brute.contamination(d, b).items() if v[4]}
    left = decontam.decontaminate(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {x for x, _ in d} - bad
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert set(cut) == {x for x, _ in d}
    assert cut[1] == " eleven" and cut[5] == "x  y  z" and cut[7] == "a " and cut[2] is None and cut[8] == dict(d)[8]


def test_empty_tables(spark, cases):
    docs, items, d, _ = cases
    assert decontam.report(docs.limit(0), items).count() == 0
    assert not any(r.contaminated for r in decontam.report(docs, items.limit(0)).collect())
