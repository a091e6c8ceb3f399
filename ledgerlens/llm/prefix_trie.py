"""Shared prefixes of conversations as a trie, rolled up by centroid decomposition.

Turns get their place by one range-partitioned sort, so that a conversation
may be longer than a partition. A prefix is known by its depth and 128 bits:
the exclusive-or of a hash of (place, role, SHA-256 of the text) of each turn.
Prefix values come from runs of RUN turns: each run's own value first, then
those of the runs before it. A node is a group of equal prefixes.

Subtree totals come from a centroid decomposition of the parent edges. A node
weighs its members, so the weight of a subtree is the number of turns at or
below its top, which the nodes' own groups give. In each round every component
of more than COMPONENT nodes is split at its centroid, the deepest node that
carries at least half of the component's weight. Nodes that carry half of it
are just the path from the centroid up to the component's top. The total of the
centroid's part below is final for the centroid and is added to every node of
that path, whose weights lose the part's. What lay below falls into one
component per child, the rest stays one, none with more than half of the
weight, so the rounds grow with the logarithm of the turns, whatever the depth
of the trie. Components of at most COMPONENT nodes are dealt out and split in the same way
down to single nodes inside one task each.

Bounds: a task holds COMPONENT nodes or a run of turns; joins on a component or
a parent have at most one row per key on the other side and are left to
adaptive splitting. The ids of a node's conversations are hashed as a stream.

Defined cases: rows with a null conv_id take no part; a null turn comes first,
equal turns go by role, then by the SHA-256 of the text; repeated rows are
turns each; null role or text is empty; texts of any length are hashed where
they are read; an empty table gives no rows, not even a root; columns other
than the four named are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import keep

#: Nodes of a component that is finished inside a task.
COMPONENT = 1 << 14
#: Turns of a conversation whose prefix values are computed together.
RUN = 1024
#: Conversations that take the first turns of one other: FAMILY numbers in a row.
FAMILY = 100
#: Borrowed turns are fewer than this.
BORROWED = 6
#: Characters of conversation ids that are handed on as one row.
_TEXT = 1 << 16
_NODE = ("depth", "x1", "x2")


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n_chars and two hashes (t1, t2) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = (conversations.where("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), F.length(text).cast("bigint").alias("n_chars"),
                     F.monotonically_increasing_id().alias("rid")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "rid"]
    sorted_ = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id's upper bits number the partition, the lower ones its rows in order
    stored = keep(sorted_.select("conv_id", "n_chars", F.xxhash64("role", "digest").alias("t1"), F.xxhash64(F.lit(1), "role", "digest").alias("t2"), F.monotonically_increasing_id().alias("row")), "turns")
    stored = stored.withColumn("part", F.shiftright("row", 33))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slices = stored.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    slices = slices.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return keep(stored.join(slices, ["conv_id", "part"]).select("conv_id", "part", (F.col("row") + F.col("shift")).alias("place"), "n_chars", "t1", "t2"), "places")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, len; turns: conv_id, place, n_chars, t1, t2) after the first turns of
    every conversation have been replaced by those of its family's first conversation."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    slices = turns.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    sizes = slices.groupBy("conv_id").agg(F.max("n").alias("n"))
    sizes = sizes.withColumn("base", base).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED)
    n_base = sizes.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    sizes = sizes.join(n_base, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    sizes = keep(sizes.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "lengths")
    # the lengths go to slices of a conversation first, so no key has more turns than a partition
    own = (turns.join(slices.join(sizes, "conv_id").select("conv_id", "part", "h", "head"), ["conv_id", "part"]).where("place > h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("place"), "n_chars", "t1", "t2"))
    first = turns.where((F.col("place") < BORROWED) & (F.col("conv_id") % FAMILY == 0)).drop("part").withColumnRenamed("conv_id", "base")
    lent = sizes.select("conv_id", "base", "head").join(first, "base").where("place <= head").select("conv_id", "place", "n_chars", "t1", "t2")
    return sizes.select("conv_id", "len"), own.unionByName(lent)


def prefixes(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for every prefix of every conversation: conv_id, depth, len (of the conversation), n_chars
    (of the last turn), x1, x2 (the prefix), p1, p2 (the one without its last turn)."""
    placed = turns.withColumn("run", F.expr(f"place div {RUN}"))
    placed = keep(placed.select("conv_id", "place", "run", "n_chars", F.xxhash64("place", "t1", "t2").alias("t1"), F.xxhash64("place", "t2", "t1").alias("t2")), "rebuilt")
    upto = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv_id", "run").agg(F.bit_xor("t1").alias("r1"), F.bit_xor("t2").alias("r2"))
    runs = runs.select("conv_id", "run", *[F.coalesce(F.bit_xor(f"r{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)]).join(lengths, "conv_id")
    # `run` and its conversation's length go to the rows of one run at a time
    rows = placed.withColumns({f"w{i}": F.bit_xor(f"t{i}").over(upto) for i in (1, 2)}).join(runs, ["conv_id", "run"])
    x = {f"x{i}": F.col(f"w{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
    rows = rows.withColumns(x).select("conv_id", F.col("place").alias("depth"), "len", "n_chars", "x1", "x2",
                                      *[F.col(f"x{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)])
    zero = F.lit(0).cast("bigint")
    roots = lengths.select("conv_id", zero.alias("depth"), "len", zero.alias("n_chars"), *[zero.alias(c) for c in ("x1", "x2", "p1", "p2")])
    return keep(rows.unionByName(roots), "prefixes")


def nodes_of(paths: DataFrame) -> DataFrame:
    """The trie: depth, x1, x2, p1, p2, conv_id, n_convs, weight (turns at or below, the node's own counted
    once per member), n_children, leaves (1 for a childless node), saved (tokens of the node alone)."""
    found = paths.groupBy(*_NODE, "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("len") - F.col("depth") + 1).alias("weight"), F.max("n_chars").alias("n_chars"))
    found = keep(found, "nodes")
    children = (found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    found = found.join(children, list(_NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return keep(found.withColumn("leaves", (F.col("n_children") == 0).cast("bigint")).withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars")), "trie")


def _key(*names: str) -> Column:
    return F.struct(*[F.col(n).alias(k) for n, k in zip(names, _NODE, strict=True)])


_TOTALS = ("leaves", "saved")


def _split(state: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round on components that are too large: (finished centroids, nodes in their new components)."""
    heavy = state.where(F.col("weight") * 2 >= F.col("total"))
    centre = F.max(F.struct("depth", "key", "conv_id", "weight")).alias("g")
    cut = state.join(heavy.groupBy("comp").agg(centre), "comp")
    # the conversation that a node is named after passes through all nodes above it
    below = paths.select(F.col("conv_id"), F.col("depth").alias("at"), _key("depth", "x1", "x2").alias("child"), F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).alias("above"))
    deeper = cut.where("depth > g.depth").withColumn("at", F.col("g.depth") + 1).join(below, ["conv_id", "at"])
    deeper = deeper.withColumn("under", F.col("above") == F.col("g.key")).drop("at", "above")
    other = cut.where("depth <= g.depth").withColumn("child", F.lit(None).cast(below.schema["child"].dataType)).withColumn("under", F.col("key") == F.col("g.key"))
    cut = keep(deeper.unionByName(other), "cut")
    sums = cut.where("under").groupBy("comp").agg(*[F.sum(c).alias(f"{c}_under") for c in _TOTALS])
    cut = cut.join(sums, "comp")
    is_centre = F.col("key") == F.col("g.key")
    finished = cut.where(is_centre).select("key", *[(F.col(f"{c}_added") + F.col(f"{c}_under")).alias(f"{c}_total") for c in _TOTALS])
    on_path = (F.col("weight") * 2 >= F.col("total")) & ~is_centre
    rest = cut.where(~is_centre).select(
        "key", "parent", "depth", "conv_id", F.when(F.col("under"), F.col("child")).otherwise(F.col("comp")).alias("comp"),
        F.when(on_path, F.col("weight") - F.col("g.weight")).otherwise(F.col("weight")).alias("weight"), *_TOTALS,
        *[(F.col(f"{c}_added") + F.when(on_path, F.col(f"{c}_under")).otherwise(0)).alias(f"{c}_added") for c in _TOTALS])
    return finished, rest


def _sized(state: DataFrame, component: int) -> DataFrame:
    """`state` with `total`, the weight of its component, null for components of at most `component` nodes."""
    sizes = state.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total")).where(F.col("n") > component)
    return state.join(sizes.drop("n"), "comp", "left")


def centroid_totals(parent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Subtree sums of `weights` (nodes x measures) in a forest of `parent` places (-1: a top)."""
    n = len(parent)
    totals, added = np.zeros_like(weights), np.zeros_like(weights)
    up, order = parent.tolist(), _by_depth(parent)
    top = list(range(n))
    members: dict[int, list[int]] = {}
    for v in order:
        if up[v] >= 0:
            top[v] = top[up[v]]
        members.setdefault(top[v], []).append(v)
    todo = list(members.values())
    size, side = [0] * n, [-1] * n
    while todo:
        part = todo.pop()  # a component, tops first
        for v in part:
            size[v] = 1
        for v in reversed(part[1:]):
            size[up[v]] += size[v]
        g = next(v for v in reversed(part) if 2 * size[v] >= len(part))
        pieces: dict[int, list[int]] = {}
        for v in part:
            # the child of the centroid a node lies under, or -1
            side[v] = -1 if v == part[0] else v if up[v] == g else side[up[v]]
            if v != g:
                pieces.setdefault(side[v], []).append(v)
        under = [g, *(v for s, vs in pieces.items() if s >= 0 for v in vs)]
        total = weights[under].sum(axis=0)
        totals[g] = added[g] + total
        v = g
        while v != part[0]:
            v = up[v]
            added[v] += total
        todo += pieces.values()
    return totals


def _by_depth(parent: np.ndarray) -> list[int]:
    """The forest's nodes, every parent before its children."""
    children: dict[int, list[int]] = {}
    for v, p in enumerate(parent.tolist()):
        children.setdefault(p, []).append(v)
    order = children.get(-1, [])[:]
    for v in order:
        order += children.get(v, ())
    return order


def _finish(state: DataFrame) -> DataFrame:
    """(key, totals) of all nodes of components that fit into a task."""
    flat = state.select(*[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k in ("comp", "key", "parent") for c in _NODE], *_TOTALS, *[f"{c}_added" for c in _TOTALS])
    names = flat.columns
    comp = names[:3]

    def solved(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        cols = {c: table[c].to_numpy() for c in names}
        place = {k: i for i, k in enumerate(zip(*(cols[f"key_{c}"].tolist() for c in _NODE), strict=True))}
        comps = list(zip(*(cols[c].tolist() for c in comp), strict=True))
        parent = np.array([place.get(p, -1) for p in zip(*(cols[f"parent_{c}"].tolist() for c in _NODE), strict=True)], np.int64)
        # an edge to another component has been cut
        parent = np.array([p if p >= 0 and comps[p] == comps[i] else -1 for i, p in enumerate(parent.tolist())], np.int64)
        totals = centroid_totals(parent, np.stack([cols[c] for c in _TOTALS], axis=1))
        # what was added to a node by earlier splits is its own
        arrays = [table[f"key_{c}"].combine_chunks() for c in _NODE]
        arrays += [pa.array(totals[:, i] + cols[f"{c}_added"], pa.int64()) for i, c in enumerate(_TOTALS)]
        return pa.RecordBatch.from_arrays(arrays, names=[*_NODE, *(f"{c}_total" for c in _TOTALS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy() for c in comp])
            starts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist()] if batch.num_rows > 1 else [0]
            first = tuple(ids[:, 0].tolist())
            # whole components are solved once enough nodes have come together
            if held and first != last and sum(b.num_rows for b in held) >= COMPONENT:
                yield solved(held)
                held = []
            edge = starts[-1]
            if edge:
                held.append(batch.slice(0, edge))
                if sum(b.num_rows for b in held) >= COMPONENT:
                    yield solved(held)
                    held = []
            held.append(batch.slice(edge))
            last = tuple(ids[:, -1].tolist())
        if held:
            yield solved(held)

    dealt = flat.repartition(*comp).sortWithinPartitions(*comp)
    solved_rows = dealt.mapInArrow(run, ", ".join([*(f"{c} bigint" for c in _NODE), *(f"{c}_total bigint" for c in _TOTALS)]))
    return solved_rows.select(_key(*_NODE).alias("key"), *[f"{c}_total" for c in _TOTALS])


def subtree_totals(trie: DataFrame, paths: DataFrame, component: int = COMPONENT) -> DataFrame:
    """depth, x1, x2, leaves_total, saved_total of every node: sums over its subtree."""
    root = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in _NODE])
    state = trie.select(_key(*_NODE).alias("key"), F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).alias("parent"), "depth", "conv_id", "weight",
                        *_TOTALS, *[F.lit(0).cast("bigint").alias(f"{c}_added") for c in _TOTALS], root.alias("comp"))
    # at first all nodes are one component
    whole = trie.agg(F.when(F.count(F.lit(1)) > component, F.max("weight")).alias("total")).scalar()
    state = keep(state.withColumn("total", whole), "components")
    done, small = [], [state.where("total IS NULL").drop("total")]
    while not state.where("total IS NOT NULL").isEmpty():
        finished, rest = _split(state.where("total IS NOT NULL"), paths)
        done.append(finished)
        state = keep(_sized(rest, component), "components")
        small.append(state.where("total IS NULL").drop("total"))
    every = small[0]
    for s in small[1:]:
        every = every.unionByName(s)
    out = _finish(every)
    for f in done:
        out = out.unionByName(f)
    return out.select("key.*", *[f"{c}_total" for c in _TOTALS])


def ends_of(paths: DataFrame) -> DataFrame:
    """depth, x1, x2, ends_sha256: SHA-256 of the comma-joined ascending ids of the conversations that end at a node."""
    order = [*_NODE, "conv_id"]
    ends = paths.where("depth = len").select(*order)

    def joined(batches):
        """Ids of one node in a partition as texts of about _TEXT characters."""
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in order])
            if not ids.shape[1]:
                continue
            edge = np.flatnonzero((ids[:3, 1:] != ids[:3, :-1]).any(axis=0)) + 1
            edge = np.unique(np.concatenate([edge, np.arange(0, ids.shape[1], _TEXT // 20), [ids.shape[1]]]))
            text = list(map(str, ids[3].tolist()))
            lo = edge[:-1]
            yield pa.RecordBatch.from_arrays([*(pa.array(ids[i, lo]) for i in range(4)), pa.array([",".join(text[a:b]) for a, b in zip(lo, edge[1:], strict=True)])], [*order, "ids"])

    def hashed(batches):
        now, state, rows = None, None, []
        for batch in batches:
            for *node, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if node != now:
                    if now:
                        rows.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            if rows:
                yield _batch(rows)
                rows = []
        if now:
            yield _batch([(*now, state.hexdigest())])

    def _batch(rows):
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [*_NODE, "ends_sha256"])

    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, ", ".join(f"{c} bigint" for c in order) + ", ids string")
    return texts.repartition(*_NODE).sortWithinPartitions(*order).mapInArrow(hashed, ", ".join(f"{c} bigint" for c in _NODE) + ", ends_sha256 string")


def report(conversations: DataFrame, component: int = COMPONENT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = prefixes(*rebuilt_turns(placed_turns(conversations)))
    trie = nodes_of(paths)
    totals = subtree_totals(trie, paths, component)
    above = trie.select(F.col("depth").alias("p0"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (trie.withColumn("p0", F.col("depth") - 1).join(above, ["p0", "p1", "p2"], "left").join(totals, list(_NODE)).join(ends_of(paths), list(_NODE), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves_total").alias("n_leaves"), F.col("saved_total").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
