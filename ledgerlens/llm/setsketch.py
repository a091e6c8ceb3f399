"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct 5-word shingles (64-bit hashes). Its
sketch holds REGISTERS registers: for each, the minimum over the shingles of an
exponential variable, put on a logarithmic scale with base 1.001 and truncated
to [0, 65535] (Ertl, SetSketch, 2021). Registers of a union are the larger of
the two sets' registers, and two sets agree in a register with a probability of
about their similarity.

1. Copies: documents with equal sets form one class (128-bit digest of the set).
2. Candidates: BANDS bands of 4 registers. The classes of a bucket are not
   paired with each other but with two pivots of the bucket.
3. Estimate: the likelihood of the similarity, jointly over the registers that
   are larger, smaller and equal, given both set sizes; pairs whose estimate is
   more than five standard deviations below the threshold are left out.
4. Verify: the full sets of both documents. Components of the links.
5. Rest: buckets that still hold several components. Every class outside the
   largest component of its bucket is compared on full sets with all classes of
   other components there, in blocks, so that the components equal those of all
   pairs within buckets. A block sends on at most one link per pair of components.

With similarity 0.75 or more two documents share no bucket with a probability
of at most (1 - 0.75**4)**32, about 5e-6.

Defined cases: null texts and texts without words have no shingles and are
linked with nothing; a null doc_id is never a component's id unless no other is
there; extra columns are left alone. Repeated rows are links of each other, and
the first keeps the text; an empty table gives no rows. Texts are taken whole,
a very long one as a piece of work of its own. Equal estimates need no order, as
every candidate is verified.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .staging import keep

SHINGLE = 5
REGISTERS = 128
ROWS = 4
BANDS = REGISTERS // ROWS
BASE = 1.001
RATE = 20.0
TOP = 65535
#: Classes of a bucket that are compared at once with as many others.
BLOCK = 256
_MULTIPLIER = W._seeded(23, REGISTERS) | np.uint64(1)
_OFFSET = W._seeded(29, REGISTERS)


def _sets(texts: list[bytes | None]):
    """Sorted distinct shingle hashes of each text."""
    w = W.words(texts, W.SPACED)
    h, place = W.grams(w, SHINGLE)
    at = np.searchsorted(w.doc[place], np.arange(len(texts) + 1))
    size = np.diff(w.first)
    short = {}
    for n in range(1, SHINGLE):
        if (size == n).any():
            g, p = W.grams(w, n)
            short.update({int(d): g[i:i + 1] for i, d in zip(*[x.tolist() for x in (np.flatnonzero(size[w.doc[p]] == n), w.doc[p][size[w.doc[p]] == n])], strict=True)})
    for d in range(len(texts)):
        yield short[d] if d in short else np.unique(h[at[d]:at[d + 1]])


def _registers(sets: list[np.ndarray]) -> np.ndarray:
    """uint16[sets, REGISTERS]; all sets are non-empty."""
    flat, at = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(flat * _MULTIPLIER[i] + _OFFSET[i], at)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n (set size), k (set digest), bands, registers; a stored table."""
    def run(batches):
        for batch in batches:
            texts = W.texts_of(batch.column(2))
            for lo, hi in W.pieces(texts):
                sets = list(_sets(texts[lo:hi]))
                some = [i for i, s in enumerate(sets) if len(s)]
                reg, band, key = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                for a in range(0, len(some), 64):
                    mine = some[a:a + 64]
                    r = _registers([sets[i] for i in mine])
                    b = W.mix(np.ascontiguousarray(r).view(np.uint64) ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(58)) ^ np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    for j, i in enumerate(mine):
                        reg[i], band[i], key[i] = r[j].tobytes(), b[j], hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(key, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(reg, pa.binary())],
                    ["doc_id", "th", "n", "k", "bands", "registers"])

    text = F.col("text").cast("string")
    return keep(docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
                .mapInArrow(run, "doc_id bigint, th bigint, n bigint, k binary, bands array<bigint>, registers binary"), "sketch")


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register rows and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    lo, hi = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    for _ in range(40):  # the likelihood has one maximum
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = likelihood(x) > likelihood(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def _estimated(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    side = lambda x: classes.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            reg = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            size = lambda c: batch.column(c).to_numpy().astype(np.float64)
            near = estimate(reg("r_a"), reg("r_b"), size("n_a"), size("n_b")) >= least
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a bigint, b bigint")


def _linked(inter, n_a, n_b, percent):
    return 100 * inter >= percent * (n_a + n_b - inter)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    side = lambda x: texts.select(F.col("c").alias(x), F.col("text").alias(f"t_{x}"))

    def run(batches):
        for batch in batches:
            a, b = W.texts_of(batch.column("t_a")), W.texts_of(batch.column("t_b"))
            yes = np.zeros(len(a), bool)
            for lo, hi in W.pieces([x + y for x, y in zip(a, b, strict=True)]):
                for i, x, y in zip(range(lo, hi), _sets(a[lo:hi]), _sets(b[lo:hi]), strict=True):
                    yes[i] = _linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a bigint, b bigint")


def _block_links(rows, percent):
    """At most one link for each pair of components between probes and members: rows (probe, root, set)."""
    members = [(root, s) for probe, root, s in rows if not probe]
    flat = np.concatenate([s for _, s in members])
    owner = np.repeat(np.arange(len(members)), [len(s) for _, s in members])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    size = np.array([len(s) for _, s in members])
    roots = np.array([r for r, _ in members])
    top: dict[int, int] = {}

    def find(x):
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for probe, root, s in rows:
        if probe:
            lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            n = hi - lo
            at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            inter = np.bincount(owner[at], minlength=len(members))
            for other in np.unique(roots[_linked(inter, len(s), size, percent) & (roots != root)]).tolist():
                if find(root) != find(other):
                    top[find(root)] = find(other)
                    yield root, other


def _rest(members: DataFrame, roots: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that still meet in a bucket."""
    placed = keep(members.join(roots.withColumnRenamed("node", "c"), "c", "left").select("key", "c", F.coalesce("root", "c").alias("root")), "placed")
    of_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("c")).alias("x"))
    mixed = (of_root.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.bit_xor("x").alias("x"))
             .where("roots > 1")
             # buckets with the same classes are compared once
             .groupBy("x", "n").agg(F.min(F.struct("key", "most")).alias("b"))
             .select("b.key", "n", F.col("b.most.root").alias("main"), (F.col("n") - F.col("b.most.n")).alias("strays")))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    own = lambda n: F.pmod(F.xxhash64("c", "key"), n)
    here = placed.join(mixed, "key").withColumn("p", blocks("strays")).withColumn("m", blocks("n"))
    probes = here.where("root != main").select("key", own(F.col("p")).alias("p"), every(F.col("m")).alias("m"), F.lit(True).alias("probe"), "root", "c")
    others = here.select("key", every(F.col("p")).alias("p"), own(F.col("m")).alias("m"), F.lit(False).alias("probe"), "root", "c")

    def run(batches):
        at, held = None, []
        for batch in batches:
            sets = _sets(W.texts_of(batch.column("text"))) if batch.num_rows else ()
            cols = [batch.column(c).to_pylist() for c in ("key", "p", "m", "probe", "root")]
            out = []
            for key, p, m, probe, root, s in zip(*cols, sets, strict=True):
                if (key, p, m) != at:
                    out += _closed(held, percent)
                    at, held = (key, p, m), []
                held.append((probe, root, s))
            yield _edge_batch(out)
        yield _edge_batch(_closed(held, percent))

    return (probes.unionByName(others).join(texts, "c").select("key", "p", "m", "probe", "root", "text")
            .repartition("key", "p", "m").sortWithinPartitions("key", "p", "m").mapInArrow(run, "a bigint, b bigint"))


def _closed(held, percent):
    return list(_block_links(held, percent)) if any(h[0] for h in held) and not all(h[0] for h in held) else []


def _edge_batch(edges):
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"])


def near_duplicates(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """doc_id, th, n_shingles, component_id and `first`, the (null?, doc_id, th) that stands for the component."""
    percent = round(100 * similarity)
    sketches = sketch(docs)
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    classes = keep(sketches.where("n > 0").groupBy("k").agg(F.min(who).alias("who"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("registers").alias("registers"))
                   .withColumn("c", F.monotonically_increasing_id()), "classes")
    keys = classes.select("c", F.explode("bands").alias("key"))
    # the pivots are the classes next to the bucket's key and farthest from it (exclusive or), so they differ by band
    buckets = (keys.groupBy("key").agg(F.min(F.col("c").bitwiseXOR(F.col("key"))).alias("lo"), F.max(F.col("c").bitwiseXOR(F.col("key"))).alias("hi"))
               .where("lo != hi").select("key", F.col("lo").bitwiseXOR(F.col("key")).alias("lo"), F.col("hi").bitwiseXOR(F.col("key")).alias("hi")))
    members = keep(keys.join(buckets, "key"), "members")
    pairs = (members.select(F.explode(F.array("lo", "hi")).alias("a"), F.col("c").alias("b")).where("a != b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    near = keep(_estimated(pairs, classes, similarity - 5 * (similarity * (1 - similarity) / REGISTERS) ** 0.5), "near")
    needed = members.select("c").distinct().join(classes.select("c", "who.doc_id", "who.th"), "c")
    text = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))
    texts = keep(source.join(needed, (source["h"] == needed["th"]) & source["d"].eqNullSafe(needed["doc_id"])).select("c", "text").dropDuplicates(["c"]), "texts")
    roots = keep(components(_verified(near, texts, percent)), "roots")
    more = components(_rest(members, roots, texts, percent)).select(F.col("node").alias("root"), F.col("root").alias("top"))
    joined = classes.select("k", "who", "c").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    joined = joined.join(more, "root", "left").select("k", "who", F.coalesce("top", "root").alias("root"))
    first = joined.groupBy("root").agg(F.min("who").alias("first"))
    of_class = joined.select("k", "root").join(first, "root").select("k", "first")
    return (sketches.select("doc_id", "th", "n", "k").join(of_class, "k", "left")
            .select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "first"))


def report(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(docs, similarity).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """`docs` with one row of each component (that of the smallest doc_id) and every row without shingles."""
    marks = keep(near_duplicates(docs, similarity), "marks")
    stays = marks.select("first.doc_id", "first.th").where("th is not null").distinct().select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    plain = plain.withColumn("_h", F.xxhash64(text.cast("string")))
    one = plain.join(stays, (F.col("_h") == F.col("_th")) & doc_id.eqNullSafe(F.col("_id"))).dropDuplicates(["_h", doc_id_name(docs, names)])
    # rows without words are recognised by themselves
    bare = plain.where(text.isNull() | ~text.cast("string").rlike(r"[^\x20\x09-\x0D]"))
    return one.select(*names).unionByName(bare.select(*names)).toDF(*docs.columns)


def doc_id_name(docs: DataFrame, names: list[str]) -> str:
    return names[docs.columns.index("doc_id")]
