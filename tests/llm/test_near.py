import random

import brute
import numpy as np
from ledgerlens.llm import registry, setsketch
from ledgerlens.llm.components import components


def _rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_on_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op3_near_duplicates(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_documents(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def _mutated(words, n, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"w{rng.random()}"
    return " ".join(words)


def test_hot_group_of_near_copies(spark):
    """Copies far from each other that only their original holds together."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(300)]
    docs = [(1000, " ".join(base))] + [(i, _mutated(base, rng.choice((2, 5, 8, 9)), rng)) for i in range(250)]
    docs += [(2000 + i, " ".join(f"o{i}_{j}" for j in range(60))) for i in range(100)]
    docs += [(3000 + i, " ".join(base)) for i in range(200)]
    assert _rows(setsketch.report(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute.near_documents(docs)


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "A  b\tc"), (6, "a b"), (7, "x" * 200_000), (8, "one two three four five six"), (9, "ONE two three four five six"), (9, "ONE two three four five six"),
            (11, "p q r s t u v w"), (None, "p q r s t u v w"), (None, "only here with no id at all")]
    df = spark.createDataFrame([(d, t, 0, "k") for d, t in docs], "doc_id bigint, text string, n int, k string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in setsketch.report(df).collect())
    assert got == [(-1, 3, None, False), (-1, 4, 11, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 7, True),
                   (8, 2, 8, True), (9, 2, 8, False), (9, 2, 8, False), (11, 4, 11, True)]
    left = setsketch.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8, 11]
    assert setsketch.report(df.limit(0)).count() == 0 and setsketch.drop_near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(3, "a b c d e f")] * 4, "doc_id bigint, text string")
    assert setsketch.drop_near_duplicates(df).count() == 1


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    for share, n in ((0.5, 400), (0.8, 900), (0.0, 300)):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[:int(n * share)], rng.integers(0, 2**63, n - int(n * share), dtype=np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        r = setsketch._registers([np.unique(a), np.unique(b)])
        assert abs(setsketch.estimate(r[:1], r[1:], np.array([n]), np.array([n]))[0] - true) < 0.13


def test_registers_merge():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**63, 200, dtype=np.uint64) for _ in range(2))
    ra, rb, both = setsketch._registers([a, b, np.concatenate([a, b])])
    assert (np.maximum(ra, rb) == both).all()


def test_components(spark):
    rng, groups = random.Random(4), brute.Groups()
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    for a, b in links:
        groups.link(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: groups.find(x) for a, b in links for x in (a, b) if a != b}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
