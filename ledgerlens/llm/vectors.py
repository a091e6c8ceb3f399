"""Embedding near-duplicates with HNSW graphs per shard.

1. Copies: equal vectors form one class. Vectors that are null, empty or zero or
   hold null or non-finite components are linked with nothing.
2. Classes are dealt by hash into shards of at most SHARD; a graph is built for
   each. One shard's graph at a time is broadcast (bounded: SHARD vectors and
   their links), and every class queries every shard.
3. Neighbours found are verified by their cosine in double precision. A query
   whose beam is full of neighbours is compared with the whole shard, so the beam
   is no limit on them. A task sends on a spanning forest of the links that it
   found, not the links.
4. Components of the links. A link joins two members of a component, so all
   links of a component are counted exactly by blocked products of its members.
5. Audit: for every vector whose vec_id is divisible by 100, in blocks of about
   AUDIT, all rows are searched exactly. Each asker's share of links that lie
   within its component counts alike, however many links it has. While their
   mean is less than TARGET in any class of askers by the number of their links
   (powers of AUDIT_STEP), the beams are doubled and step 2 repeats.

Vectors of different lengths are never compared. Defined cases: repeated rows
are links of each other; a null vec_id names no component unless no other is
there; extra columns and labels play no part; an empty table gives no rows.
Equal cosines need no order: every link at or above the limit counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hnsw
from .components import components
from .staging import keep

COSINE = 0.95
SHARD = 1 << 16
SHARDS = 4
BEAM = 64
AUDIT = 4096
AUDIT_STEP = 4
TARGET = 0.995
BLOCK = 1024


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, dim)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, k) of every row (k: digest of a usable vector), and the classes: c, k, v (bytes), dim, copies, vec_id."""
    def run(batches):
        for batch in batches:
            keys, raw = [], []
            for x in batch.column(1).to_pylist():
                v = None if not x or None in x else np.array(x, np.float32)
                ok = v is not None and np.isfinite(v).all() and v.any()
                raw.append(v.tobytes() if ok else None)
                keys.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "k", "v"])

    rows = keep(vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>")).mapInArrow(run, "vec_id bigint, k binary, v binary"), "vectors")
    classes = (rows.where("k is not null").groupBy("k").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("vec_id"),
                                                            F.max(F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False))).alias("asks"))
               .withColumn("dim", (F.octet_length("v") / 4).cast("int")).withColumn("c", F.monotonically_increasing_id()))
    return rows.select("vec_id", "k"), keep(classes, "classes")


def _graphs(classes: DataFrame, shards: int) -> DataFrame:
    """dim, shard and a graph for each: c, v (in the graph's order), sizes and links of its layers."""
    def run(batches):
        at, held = None, []
        for batch in batches:
            for dim, shard, c, v in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (dim, shard) != at and held:
                    yield graph(*at, held)
                    held = []
                at = (dim, shard)
                held.append((c, v))
        if held:
            yield graph(*at, held)

    def graph(dim, shard, held):
        c = np.array([x for x, _ in held], np.int64)
        x = np.frombuffer(b"".join(v for _, v in held), np.float32).reshape(-1, dim)
        rng = np.random.default_rng(shard)
        level = hnsw.levels(1 - rng.random(len(c)))
        order = np.argsort(-level, kind="stable")
        layers = hnsw.build(_unit(x[order]).astype(np.float32), level[order])
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([shard], pa.int32()), pa.array([c[order].tobytes()], pa.binary()), pa.array([x[order].tobytes()], pa.binary()),
             pa.array([[len(k) for k in layers]], pa.list_(pa.int64())), pa.array([[k.astype(np.int32).tobytes() for k in layers]], pa.list_(pa.binary()))],
            ["dim", "shard", "c", "v", "sizes", "links"])

    dealt = classes.select("dim", F.pmod(F.xxhash64("c"), F.lit(shards)).cast("int").alias("shard"), "c", "v")
    return keep(dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard").mapInArrow(
        run, "dim int, shard int, c binary, v binary, sizes array<bigint>, links array<binary>"), "graphs")


def _forest(a: np.ndarray, b: np.ndarray):
    """Links that connect what all links (a, b) connect."""
    top: dict[int, int] = {}

    def find(x):
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = find(x), find(y)
        if rx != ry:
            top[rx] = ry
            yield x, y


def _new_links(labels: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """One of `hit` for each label among them, which then share a label: links to
    these connect a point with all of `hit`, given the links taken before."""
    seen, first = np.unique(labels[hit], return_index=True)
    if len(seen) > 1:
        labels[np.isin(labels, seen)] = seen[0]
    return hit[first]


def _found(classes: DataFrame, graphs: DataFrame, beam: int, cosine: float) -> DataFrame:
    """Links (a, b) that connect what the verified neighbours of all classes connect; stored."""
    sc = classes.sparkSession.sparkContext
    out = None
    for place in graphs.select("dim", "shard").orderBy("dim", "shard").collect():
        g = graphs.where((F.col("dim") == place["dim"]) & (F.col("shard") == place["shard"])).first()
        shared = sc.broadcast((place["dim"], bytes(g["c"]), bytes(g["v"]), list(g["sizes"]), [bytes(x) for x in g["links"]]))

        def run(batches, shared=shared):
            dim, c, v, sizes, links = shared.value
            c, exact = np.frombuffer(c, np.int64), _unit(np.frombuffer(v, np.float32).reshape(-1, dim))
            x = exact.astype(np.float32)
            layers = [np.frombuffer(k, np.int32).reshape(n, -1) for n, k in zip(sizes, links, strict=True)]
            labels = np.arange(len(c))
            for batch in batches:
                if not batch.num_rows:
                    continue
                mine, q = batch.column(0).to_numpy(), _unit(_matrix(batch.column(1), dim))
                a, b = [], []
                for lo, ids, sims in hnsw.search(x, layers, q.astype(np.float32), beam):
                    r, k = np.nonzero((ids >= 0) & (sims >= cosine - 1e-4))
                    full = np.flatnonzero((ids >= 0).all(axis=1) & (sims.min(axis=1) >= cosine - 1e-4) & (ids.shape[1] < len(c)))
                    open_ = ~np.isin(r, full)
                    r, hit = r[open_], ids[r, k][open_]
                    yes = (np.einsum("nd,nd->n", q[lo + r], exact[hit]) >= cosine) & (mine[lo + r] != c[hit])
                    a.append(mine[lo + r[yes]])
                    b.append(c[hit[yes]])
                    for row in range(0, len(full), 64):
                        some = lo + full[row:row + 64]
                        for one, linked in zip(mine[some], q[some] @ exact.T >= cosine, strict=True):
                            hit = _new_links(labels, np.flatnonzero(linked & (c != one)))
                            a.append(np.full(len(hit), one))
                            b.append(c[hit])
                pairs = list(_forest(np.concatenate(a), np.concatenate(b)))
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

        links = classes.where(F.col("dim") == place["dim"]).select("c", "v").mapInArrow(run, "a bigint, b bigint")
        out = links if out is None else out.unionByName(links)
    return keep(out, "found") if out is not None else classes.sparkSession.createDataFrame([], "a bigint, b bigint")


def _counts(members: DataFrame, cosine: float) -> DataFrame:
    """c, n: copies of other classes linked with class c, from members (root, dim, c, v, copies) of components."""
    sized = members.join(members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "root")
    sized = sized.withColumn("own", F.pmod(F.xxhash64("c", F.lit(5)), F.col("blocks"))).withColumn("each", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    left = sized.select("root", F.col("own").alias("i"), F.col("each").alias("j"), F.lit(True).alias("asks"), "dim", "c", "v", "copies")
    right = sized.select("root", F.col("each").alias("i"), F.col("own").alias("j"), F.lit(False).alias("asks"), "dim", "c", "v", "copies")

    def run(batches):
        at, held = None, []
        for batch in batches:
            for root, i, j, asks, dim, c, v, copies in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (root, i, j) != at and held:
                    yield count(held)
                    held = []
                at = (root, i, j)
                held.append((asks, dim, c, v, copies))
        if held:
            yield count(held)

    def count(held):
        x, y = [h for h in held if h[0]], [h for h in held if not h[0]]
        c = np.array([h[2] for h in x], np.int64)
        if not x or not y:
            return pa.RecordBatch.from_arrays([pa.array(c[:0]), pa.array(c[:0])], ["c", "n"])
        vectors = lambda rows: _unit(np.frombuffer(b"".join(h[3] for h in rows), np.float32).reshape(len(rows), -1))
        linked = (vectors(x) @ vectors(y).T >= cosine) & (c[:, None] != np.array([h[2] for h in y], np.int64)[None, :])
        return pa.RecordBatch.from_arrays([pa.array(c), pa.array(linked @ np.array([h[4] for h in y], np.int64))], ["c", "n"])

    pairs = left.unionByName(right).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return pairs.mapInArrow(run, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n"))


def recall(placed: DataFrame, cosine: float, audit: int = AUDIT) -> float:
    """The least mean share, over classes of asking vectors by the number of their links, of an
    asker's links (found by comparing it with all rows) whose ends have its root; `placed`: root,
    dim, c, v, copies, asks. Without any link it is 1. `audit` askers are taken at a time."""
    spark = placed.sparkSession
    askers = placed.where("asks").select("dim", "c", "root", "v")
    blocks = max(1, -(-askers.count() // audit))
    sums: dict[int, list[float]] = {}
    for i in range(blocks):
        rows = askers.where(F.pmod(F.xxhash64("c", F.lit(9)), F.lit(blocks)) == i).collect()
        shared = spark.sparkContext.broadcast([(r["dim"], r["c"], r["root"], bytes(r["v"])) for r in rows])

        def run(batches, shared=shared):
            by_dim, found = {}, {}
            for dim, c, root, v in shared.value:
                by_dim.setdefault(dim, []).append((c, root, v))
            asked = {dim: (_unit(np.frombuffer(b"".join(x[2] for x in asks), np.float32).reshape(-1, dim)), *(np.array([x[i] for x in asks], np.int64) for i in (0, 1)))
                     for dim, asks in by_dim.items()}
            for batch in batches:
                dims, roots = batch.column("dim").to_numpy(), batch.column("root").to_numpy()
                c, copies, v = batch.column("c").to_numpy(), batch.column("copies").to_numpy(), batch.column("v").to_pylist()
                for dim, (q, ids, top) in asked.items():
                    n, same = found.setdefault(dim, (np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)))
                    for at in np.array_split(np.flatnonzero(dims == dim), max(1, (dims == dim).sum() // 2048)):
                        if len(at):
                            linked = (q @ _unit(np.frombuffer(b"".join(v[i] for i in at), np.float32).reshape(-1, dim)).T >= cosine) & (ids[:, None] != c[at])
                            n += linked @ copies[at]
                            same += (linked & (top[:, None] == roots[at])) @ copies[at]
            for dim, (n, same) in found.items():
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(asked[dim][1][some]), pa.array(n[some]), pa.array(same[some])], ["c", "n", "same"])

        each = (placed.select("root", "dim", "c", "v", "copies").mapInArrow(run, "c bigint, n bigint, same bigint")
                .groupBy("c").agg(F.sum("n").alias("n"), F.sum("same").alias("same")))
        size = F.floor(F.log(float(AUDIT_STEP), F.col("n"))).cast("int").alias("size")
        for r in each.groupBy(size).agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("same") / F.col("n")).alias("share")).collect():
            mine = sums.setdefault(r["size"], [0, 0.0])
            mine[0] += r["m"]
            mine[1] += r["share"]
        shared.unpersist()
    return min((share / m for m, share in sums.values()), default=1.0)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, beam: int = BEAM, target: float = TARGET, shard: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, beam (the width that passed) and recall (the audit's)."""
    rows, classes = classes_of(vectors)
    n = classes.count()
    graphs = _graphs(classes, max(SHARDS, -(-n // shard)))
    while True:
        roots = components(_found(classes, graphs, beam, cosine)).withColumnRenamed("node", "c")
        placed = keep(classes.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c")), "placed")
        seen = recall(placed, cosine)
        if seen >= target or beam >= 2 * shard:
            break
        beam *= 2
    shared_root = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count(F.lit(1)).alias("_size"))
    placed = placed.join(shared_root, "root")
    counts = _counts(placed.where("_size > 1").select("root", "dim", "c", "v", "copies"), cosine)
    of_class = placed.join(counts, "c", "left").select("k", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(of_class, "k", "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(beam).alias("beam"), F.lit(seen).alias("recall"))
