"""Hard negatives by Fagin's threshold algorithm.

Vectors are scaled to integers and dealt into shards of a bounded number of
components. Each shard keeps one sorted list of its rows per dimension. An
anchor reads every list from the end that its own component's sign makes best,
all lists to the same depth. Rows met for the first time are scored at once,
as integer inner products. No row still unmet can score more than the
threshold, the sum of the anchor's components times the values last read. A
scan ends when the threshold lies strictly below the k-th score of every
window (below its lower bound while the window holds fewer than k rows), as a
row of equal score could still win its tie by a smaller id.

Anchors meet the shards in blocks: every (shard, block) is one task, and the
blocks of all shards are merged by rank. One pass finds an anchor's positives,
a second one the negatives within the windows that these set.

Bounds: a shard has about SHARD components and a block about BLOCK, whatever
the number of rows; a task emits at most `n_negatives` rows per window.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; scaled components are held within +-LARGEST, so that
100 times a score fits a long; in vectors of unequal length the missing
components are 0; equal scores go by vec_id; repeated rows are rows of their
own, each an anchor, a positive or a negative; an empty table gives no rows;
columns other than the three named are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import keep

#: Components of a shard and of a block of anchors.
SHARD = 1 << 19
BLOCK = 1 << 20
#: Components after scaling.
LARGEST = 1 << 22
SCALE = 256
#: Rows that are read from every list before the first look at the threshold.
_FIRST = 16


def scaled(vectors: DataFrame) -> DataFrame:
    """rid, vec_id, label, q: the rows that take part, components as floor(256 * x)."""
    usable = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.least(F.greatest(F.floor(x.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    return (vectors.where(usable & F.coalesce(finite, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), whole.alias("q")))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors as rows of int32, filled up with zeros."""
    flat = column.combine_chunks()
    size = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), dims), np.int32)
    out[np.arange(dims) < size[:, None]] = flat.flatten().to_numpy()
    return out


def _packed(rows: DataFrame, group: str, dims: int, sort: bool) -> DataFrame:
    """One row per `group`: its rows' columns as binaries, with each dimension's order if `sort`."""
    longs = [c for c in rows.columns if c not in (group, "q", "bounds")]
    windows = "bounds" in rows.columns

    def run(table: pa.Table) -> pa.Table:
        q = _matrix(table["q"], dims)
        out = {group: [table[group][0].as_py()], **{c: [table[c].to_numpy().astype(np.int64).tobytes()] for c in longs}, "q": [q.tobytes()]}
        if sort:
            out["lists"] = [np.argsort(q, axis=0, kind="stable").T.astype(np.int32).tobytes()]
        if windows:
            bounds = table["bounds"].combine_chunks()
            out["bounds"] = [bounds.flatten().to_numpy().astype(np.int64).tobytes()]
            out["n_bounds"] = [np.diff(bounds.offsets.to_numpy()).astype(np.int64).tobytes()]
        schema = pa.schema([(c, pa.int64() if c == group else pa.binary()) for c in out])
        return pa.table(out, schema)

    more = ["lists"] * sort + ["bounds", "n_bounds"] * windows
    return rows.groupBy(group).applyInArrow(run, ", ".join([f"{group} bigint", *(f"{c} binary" for c in [*longs, "q", *more])]))


class _Shard:
    """A shard's rows and sorted lists."""

    def __init__(self, row: dict, dims: int):
        self.rid, self.vec_id, self.label = (np.frombuffer(row[c], np.int64) for c in ("rid", "vec_id", "label"))
        self.n, self.dims = len(self.rid), dims
        self.q = np.frombuffer(row["q"], np.int32).reshape(self.n, dims)
        self.lists = np.frombuffer(row["lists"], np.int32).reshape(dims, self.n)
        self.largest = float(np.abs(self.q).max(initial=0))
        self.exact = self.q.astype(np.float64)
        self.whole = None

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        # doubles hold the products exactly while no sum can reach 2**53
        if self.largest * float(np.abs(anchor).sum()) < 2.0**53:
            return (self.exact[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return (self.q[rows].astype(np.int64) * anchor.astype(np.int64)).sum(axis=1)

    def scan(self, anchor: np.ndarray):
        """Yields (rows met first at this depth, their scores, threshold); a threshold of None ends the lists."""
        if not self.dims:
            yield np.arange(self.n), np.zeros(self.n, np.int64), None
            return
        up = anchor < 0
        dim = np.arange(self.dims)
        met, depth, step = np.zeros(self.n, bool), 0, _FIRST
        while depth < self.n:
            to = min(depth + step, self.n)
            new = np.zeros(self.n, bool)
            new[self.lists[up, depth:to]] = True
            new[self.lists[~up, self.n - to:self.n - depth]] = True
            new &= ~met
            met |= new
            rows = np.flatnonzero(new)
            last = np.where(up, self.lists[:, to - 1], self.lists[:, self.n - to])
            limit = int((anchor.astype(np.int64) * self.q[last, dim]).sum())
            yield rows, self.scores(rows, anchor), None if to == self.n or met.all() else limit
            depth, step = to, to


def _best(score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then by smaller vec_id."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= kth)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((vec_id[some], -score[some]))][:k]


def _candidates(shard: _Shard, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int):
    """(rows, scores): the k best allowed rows of each window (lo, hi) of scores."""
    row, score = np.empty(0, np.int64), np.empty(0, np.int64)
    for rows, scores, limit in shard.scan(anchor):
        use = allowed[rows]
        row, score = np.concatenate([row, rows[use]]), np.concatenate([score, scores[use]])
        if limit is None:
            break
        for lo, hi in windows:
            inside = score[(score >= lo) & (score <= hi)]
            if limit >= (np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else lo):
                break
        else:
            break
    chosen = np.zeros(len(row), bool)
    for lo, hi in windows:
        inside = np.flatnonzero((score >= lo) & (score <= hi))
        chosen[inside[_best(score[inside], shard.vec_id[row[inside]], k)]] = True
    return row[chosen], score[chosen]


_FOUND = "anchor bigint, rid bigint, vec_id bigint, score bigint"
_EVERY = (-(1 << 62), 1 << 62)


def _searched(shards: DataFrame, blocks: DataFrame, n_shards: int, n_blocks: int, dims: int, same: bool, k: int) -> DataFrame:
    """Best rows of every shard for every anchor: of the anchor's label (`same`) over all scores, else
    of other labels in each of its windows."""
    cells = shards.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    asked = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_shards - 1).cast("bigint"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [[] for _ in range(4)]
        if left.num_rows and right.num_rows:
            shard, block = _Shard(left.to_pylist()[0], dims), right.to_pylist()[0]
            rid, label = (np.frombuffer(block[c], np.int64) for c in ("rid", "label"))
            anchors = np.frombuffer(block["q"], np.int32).reshape(len(rid), dims)
            if not same:
                ends = np.cumsum(np.frombuffer(block["n_bounds"], np.int64))
                bounds = np.frombuffer(block["bounds"], np.int64)
            for i in range(len(rid)):
                if same:
                    allowed, windows = (shard.label == label[i]) & (shard.rid != rid[i]), [_EVERY]
                else:
                    mine = bounds[ends[i - 1] if i else 0:ends[i]]
                    allowed, windows = shard.label != label[i], list(zip(mine[0::2].tolist(), mine[1::2].tolist(), strict=True))
                rows, scores = _candidates(shard, anchors[i], allowed, windows, k)
                for part, values in zip(parts, (np.full(len(rows), rid[i]), shard.rid[rows], shard.vec_id[rows], scores), strict=True):
                    part.append(values)
        names = ["anchor", "rid", "vec_id", "score"]
        return pa.table({c: pa.array(np.concatenate(p) if p else np.empty(0, np.int64), pa.int64()) for c, p in zip(names, parts, strict=True)})

    return cells.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, _FOUND)


def _ranked(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "rid")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def mine(rows: DataFrame, is_anchor, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of the anchors among `rows` (rid, vec_id, label, q: a result of `scaled`).

    For each anchor and each of its `n_positives` best other rows of the same
    label: the `n_negatives` best rows of other labels whose score lies
    between `low` and `high` percent of the positive's. Columns: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = keep(rows, "scaled-vectors")
    n, dims, n_anchors = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0)), F.count_if(is_anchor)).first()
    n_shards = max(1, -(-n * max(dims, 1) // SHARD))
    n_blocks = max(1, -(-n_anchors * max(dims, 1) // BLOCK))
    spread = lambda of: F.pmod(F.xxhash64("rid"), F.lit(of))
    shards = keep(_packed(rows.withColumn("shard", spread(n_shards)), "shard", dims, sort=True), "sorted-lists")
    anchors = rows.where(is_anchor)
    block = spread(n_blocks).alias("block")
    asked = _packed(anchors.select(block, "rid", "label", "q"), "block", dims, sort=False)
    positives = keep(_ranked(_searched(shards, asked, n_shards, n_blocks, dims, True, n_positives), ["anchor"], n_positives, "place"), "positives")
    # an empty window has no place for a negative: 30 % of a score below zero lies above 90 % of it
    windows = (positives.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
               .withColumn("lo", F.expr(f"({low} * positive_score + 99) div 100")).withColumn("hi", F.expr(f"{high} * positive_score div 100"))
               .where("positive_score >= 0 AND lo <= hi"))
    bounds = windows.groupBy("anchor").agg(F.flatten(F.collect_set(F.array("lo", "hi"))).alias("bounds"))
    asked = _packed(anchors.join(bounds, F.col("rid") == F.col("anchor")).select(block, "rid", "label", "q", "bounds"), "block", dims, sort=False)
    found = _searched(shards, asked, n_shards, n_blocks, dims, False, n_negatives)
    inside = found.join(windows, "anchor").where("score BETWEEN lo AND hi")
    best = _ranked(inside, ["anchor", "place"], n_negatives, "rank")
    return (best.join(anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def relabelled(rows: DataFrame) -> DataFrame:
    """`rows` with label (label + 1) % 10 where vec_id is divisible by 7."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def report(vectors: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100, after `relabelled`."""
    return mine(relabelled(scaled(vectors)), F.col("vec_id") % 100 == 0)
