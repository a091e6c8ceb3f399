import brute
import numpy as np
from ledgerlens.llm import hnsw, registry, vectors


def _plain(rows, cosine=0.95):
    """{row: (n_links, component)} of (vec_id, vector) rows."""
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    groups, links = brute.Groups(), [0] * len(rows)
    for a in ok:
        for b in ok:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1], np.float32).astype(np.float64) for i in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    groups.link(a, b)
    least = {}
    for i, (vec, _) in enumerate(rows):
        if vec is not None:
            least[groups.find(i)] = min(vec, least.get(groups.find(i), vec))
    return sorted(((vec or -1), links[i], least.get(groups.find(i), -1)) for i, (vec, _) in enumerate(rows))


def _rows(df):
    return sorted((-1 if r.vec_id is None else r.vec_id or -1, r.n_links, -1 if r.component_id is None else r.component_id) for r in df.collect())


def test_query_on_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = registry.op4_embeddings(spark, sf_dir).collect()
    v = np.array([x for _, x in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    n = ((v @ v.T) >= 0.95).sum(axis=1) - 1
    assert {r.vec_id: r.n_links for r in got} == {i: k for (i, _), k in zip(rows, n, strict=True)}


def test_groups_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((4, 16))
    rows = [(i + 1, [float(x) for x in np.float32(centre[i % 4] + rng.standard_normal(16) * (0.02, 0.12, 0.2, 0.3)[i % 4])]) for i in range(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(1000, rows[0][1]), (None, rows[1][1])]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None]), (2004, []), (2005, [float("inf")] + [1.0] * 15), (2006, [1.0, 0.0]), (2007, [2.0, 0.0]), (2008, [3e38] * 16), (2009, [1e-38] * 16)]
    df = spark.createDataFrame([(i, v, 1, "k") for i, v in rows], "vec_id bigint, embedding array<float>, n_links int, k string")
    assert _rows(vectors.near_duplicates(df)) == _plain(rows)
    assert _rows(vectors.near_duplicates(df, shard=40, beam=4)) == _plain(rows)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_audit_widens_the_beam(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i * 100, [float(x) for x in rng.standard_normal(8)]) for i in range(60)]
    df = spark.createDataFrame(rows + [(i + 1, v) for i, v in rows], "vec_id bigint, embedding array<float>")
    seen = iter((0.2, 0.5, 1.0))
    monkeypatch.setattr(vectors, "recall", lambda *a, **k: next(seen))
    assert {r.beam for r in vectors.near_duplicates(df, beam=4).collect()} == {16}


def _two_groups():
    """Two tight groups of 150 (cosine about 0.99 inside, 0.96 across)."""
    rng = np.random.default_rng(8)
    e = np.eye(24)
    centre = [e[0], 0.975 * e[0] + np.sqrt(1 - 0.975**2) * e[1]]
    out = []
    for i in range(300):
        u = rng.standard_normal(24)
        u[:2] = 0
        out.append(centre[i % 2] + 0.08 * u / np.linalg.norm(u))
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(out)]


def test_full_beams_hide_no_links(spark):
    rows = _two_groups()
    v = np.array([x for _, x in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = np.argsort(-(v @ v.T), axis=1)[:, :8]
    assert ((near % 2) == (np.arange(300) % 2)[:, None]).all()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = vectors.near_duplicates(df, beam=8, target=0.0)
    assert _rows(got) == _plain(rows) and {r.component_id for r in got.collect()} == {0}


def test_audit_counts_every_asker_alike(spark):
    """One group of 300 copies that is found must not hide 30 pairs that are not."""
    rng = np.random.default_rng(9)
    hot, pairs = np.float32(rng.standard_normal(32)), np.float32(rng.standard_normal((30, 32)))
    rows = [(1, -1, hot, 300), (2, -1, hot * np.float32(2), 1)]
    for i, p in enumerate(pairs):
        rows += [(100 + 2 * i, 100 + 2 * i, p, 1), (101 + 2 * i, 101 + 2 * i, p * np.float32(3), 1)]
    placed = spark.createDataFrame([(c, root, 32, bytearray(np.float32(v).tobytes()), n, True) for c, root, v, n in rows],
                                   "c bigint, root bigint, dim int, v binary, copies bigint, asks boolean")
    assert vectors.recall(placed, 0.95) < 0.05 and vectors.recall(placed, 0.95, audit=7) < 0.05
    assert vectors.recall(placed.withColumn("root", placed["dim"].cast("bigint")), 0.95, audit=7) == 1.0


def test_graph_recall():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((5000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    level = np.sort(hnsw.levels(1 - rng.random(len(x))))[::-1]
    layers = hnsw.build(x, level)
    q = x[:300] + 0.1 * rng.standard_normal((300, 32)).astype(np.float32)
    true = np.argsort(-(q @ x.T), axis=1)[:, :10]
    found = np.concatenate([ids for _, ids, _ in hnsw.search(x, layers, q, 100)])
    recall = np.mean([len({*t} & {*f}) / 10 for t, f in zip(true.tolist(), found[:, :100].tolist(), strict=True)])
    assert recall > 0.9
