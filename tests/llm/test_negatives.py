import math
import random

import numpy as np
import pytest
from ledgerlens.llm import negatives, registry
from pyspark.sql import functions as F


def brute(rows):
    """The contract over (vec_id, vector, label) tuples, in plain Python."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, [math.floor(256 * x) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (anchor, q, label) in enumerate(usable):
        if anchor % 100:
            continue
        scored = sorted((-dot(q, w), v, same == label) for j, (v, w, same) in enumerate(usable) if j != i)
        for s, positive, _ in [x for x in scored if x[2]][:5]:
            kept = [x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(anchor, positive, rank, v, -s, -t) for rank, (t, v, _) in enumerate(kept, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(spark, rows, kind="double"):
    table = spark.createDataFrame([(*r, 1, [0.0]) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, score int, q array<double>")
    return sorted(tuple(r) for r in negatives.report(table.repartition(4)).select(*COLUMNS).collect())


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = registry.op11_hard_negatives(spark, sf_dir)
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == brute(rows)


@pytest.fixture
def many_shards(monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 150)
    monkeypatch.setattr(negatives, "BLOCK", 12)
    monkeypatch.setattr(negatives, "_FIRST", 2)


def test_ties_copies_and_odd_rows(spark, many_shards):
    rnd = random.Random(2)
    copied = [0.5, 0.25, -0.5]  # a third of all rows
    rows = [(i, copied if i % 3 == 0 else [rnd.choice([-1.0, -0.3, 0.0, 0.1, 0.4, 1.0]) for _ in range(3)], rnd.randint(0, 3)) for i in range(-200, 260)]
    rows += [rows[0], rows[200], rows[200], (None, copied, 1), (300, None, 1), (400, [0.1, None, 0.2], 1), (500, [0.1, float("nan"), 0.2], 1), (600, [float("inf"), 0.0, 0.0], 1),
             (700, copied, None), (800, [], 2), (900, [0.7], 2), (901, [0.7, 0.2], 3), (902, [0.9, 0.1, 0.3], 3)]
    got = found(spark, rows)
    assert got == brute(rows) and len(got) > 300


def test_few_rows_and_none(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0, 2.0], 1)]) == []
    few = [(100, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.5, 0.2], 2), (3, [-1.0, 0.0], 2)]
    assert found(spark, few) == brute(few) and [r[:4] for r in brute(few)] == [(100, 1, 1, 2)]
    huge = [(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1), (2, [-1e30, 1.0], 2)]
    assert found(spark, huge) == []


def test_scan_stops_early_and_misses_nothing():
    """On skewed components a scan ends long before the lists do; what it returns equals a full look."""
    rnd = np.random.default_rng(4)
    q = (256 * rnd.pareto(2.0, (4000, 3))).astype(np.int32)
    row = {"rid": np.arange(4000).tobytes(), "vec_id": np.arange(4000).tobytes(), "label": np.zeros(4000, np.int64).tobytes(), "q": q.tobytes(),
           "lists": np.argsort(q, axis=0, kind="stable").T.astype(np.int32).tobytes()}
    shard = negatives._Shard(row, 3)
    for _ in range(20):
        anchor = q[rnd.integers(4000)]
        met = [0]
        plain = shard.scan
        shard.scan = lambda a, plain=plain, met=met: ((met.__setitem__(0, met[0] + len(r)) or (r, s, t)) for r, s, t in plain(a))
        rows, scores = negatives._candidates(shard, anchor, np.ones(4000, bool), [negatives._EVERY], 5)
        shard.scan = plain
        every = q.astype(np.int64) @ anchor.astype(np.int64)
        best = sorted((-int(s), i) for i, s in enumerate(every.tolist()))[:5]
        assert sorted((-s, i) for i, s in zip(rows.tolist(), scores.tolist(), strict=True)) == best
        assert met[0] < 2000


def test_own_anchors_and_windows(spark, many_shards):
    rnd = random.Random(8)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)], i % 4) for i in range(80)]
    table = negatives.scaled(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    got = negatives.mine(table, F.col("vec_id") < 3, n_positives=2, n_negatives=4, low=10, high=50).collect()
    assert {r.anchor_id for r in got} <= {0, 1, 2} and all(10 * r.positive_score <= 100 * r.negative_score <= 50 * r.positive_score and r["rank"] <= 4 for r in got) and got
