"""Packing tokenised documents into near-equal windows by Karmarkar-Karp differencing.

A document's leading windows of `capacity` tokens are sequences of their own.
What is left of it joins a bucket of the task. A bucket of BUCKET remainders is
divided into as many windows as its tokens fill: each remainder starts as a
partition with one window in use, and the two partitions with the largest
imbalances are merged, the fullest windows of one with the emptiest of the
other, until one is left. Its windows are near-equal. Where one exceeds the
capacity its excess is cut off and fills the others' room; tokens without room
raise the number of windows by one. That last window goes into the task's next
bucket, and the last ones of all tasks are divided in the same way in groups of
BUCKET tasks, level by level, so that at most one sequence of the whole corpus
is not full, and none is padded but that.

Bounds: a task holds one bucket (BUCKET remainders shorter than `capacity`) and
a step of text; the rows of a group are the last windows of BUCKET tasks.

Defined cases: a null text is empty and gives the end token alone; repeated
rows are packed each; a null doc_id is kept; a text of any length is worked on
in steps; remainders of equal length go in the order of the table; an empty
table gives no rows; columns other than doc_id and text are left alone.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .staging import keep
from .tokens import token_ids, worker_encoder

CAPACITY = 1024
#: Remainders that are divided at once, and tasks whose last windows are.
BUCKET = 512
END = 0
#: Bits of a sequence's number within a task, and of the task's number.
_OWN, _PART = 30, 28
_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, own bigint, offset bigint, ids binary"
_ARROW = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _SCHEMA.split(", ")])


def differenced(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: the items of `k` near-equal windows."""
    # a partition is its windows in use, fullest first: (tokens below zero, node of a tree whose leaves are items)
    heap = [(-s, i, [(-s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    born, joined = len(heap), []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = len(a) + len(b) - k
        if both <= 0:  # windows in use meet empty ones
            merged = a + b
        else:  # the i-th fullest of `a` meets the i-th emptiest of `b`, which may be empty
            at, to = len(a) - both, len(b) - both
            node = len(sizes) + len(joined)
            pairs = list(zip(a[at:], reversed(b[to:]), strict=True))
            joined += [(x[1], y[1]) for x, y in pairs]
            merged = a[:at] + [(x[0] + y[0], node + i) for i, (x, y) in enumerate(pairs)] + b[:to]
        merged.sort()
        imbalance = (merged[-1][0] if len(merged) == k else 0) - merged[0][0]
        heapq.heappush(heap, (-imbalance, born, merged))
        born += 1
    windows = []
    for _, top in heap[0][2] if heap else ():
        nodes, items = [top], []
        while nodes:
            v = nodes.pop()
            if v < len(sizes):
                items.append(v)
            else:
                nodes += joined[v - len(sizes)]
        windows.append(items)
    return windows


def _length(pieces: list[tuple]) -> int:
    return sum(len(p[2]) for p in pieces)


def _split(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
    """The first `n` tokens and the others; a piece (doc_id, start, ids, doc_tokens) may be cut."""
    head = []
    for i, (doc, start, ids, total) in enumerate(pieces):
        if len(ids) > n:
            return ([*head, (doc, start, ids[:n], total)] if n else head), [(doc, start + n, ids[n:], total), *pieces[i + 1:]]
        head.append(pieces[i])
        n -= len(ids)
    return head, []


def divided(items: list[list[tuple]], capacity: int) -> tuple[list[list[tuple]], list[tuple]]:
    """Full windows, and the pieces of one more that is not full, from items of several pieces each."""
    sizes = [_length(x) for x in items]
    k = sum(sizes) // capacity
    if not k:
        return [], [p for x in items for p in x]
    windows = [sorted((p for i in w for p in items[i]), key=lambda p: -len(p[2])) for w in differenced(sizes, k)]
    windows += [[] for _ in range(k - len(windows))]
    excess = []
    for i, w in enumerate(windows):
        windows[i], more = _split(w, capacity)
        excess += more
    for w in windows:
        room = capacity - _length(w)
        if room:
            fill, excess = _split(excess, room)
            w += fill
    return windows, excess


class _Rows:
    """Pieces of one task, or of one group of tasks, as columns."""

    def __init__(self, part: int, with_ids: bool):
        self.part, self.with_ids, self.next, self.rows = part, with_ids, 0, []

    def add(self, window: list[tuple], open_: bool = False):
        """A window's pieces, with a number unless it stays open for the next level."""
        offset = 0
        for doc, start, ids, total in window:
            data = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(data), total, self.part, None if open_ else self.next, offset, data if open_ or self.with_ids else None))
            offset += len(ids)
        self.next += bool(window) and not open_

    def taken(self) -> list:
        """The rows so far as columns, which are then forgotten."""
        out = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), _ARROW, strict=True)] if self.rows else [pa.array([], f.type) for f in _ARROW]
        self.rows = []
        return out


def _first_level(docs: DataFrame, tokenizer: str, capacity: int, bucket: int, with_ids: bool) -> DataFrame:
    def run(batches):
        encoder, rows, items = worker_encoder(tokenizer), _Rows(TaskContext.get().partitionId(), with_ids), []
        for batch in batches:
            ids_of, held, full, start = batch.column(0).to_pylist(), np.empty(0, np.uint32), [], 0
            for i, ids, last in token_ids(W.texts_of(batch.column(1)), encoder):
                held = np.concatenate([held, ids, np.array([END] * last, np.uint32)])
                whole = len(held) // capacity * capacity
                for at in range(0, whole, capacity):
                    piece = held[at:at + capacity].astype("<u4").tobytes()
                    full.append((start + at, zlib.crc32(piece), piece if with_ids else None))
                start, held = start + whole, held[whole:]
                if last:
                    total = start + len(held)
                    for at, crc, piece in full:
                        rows.rows.append((ids_of[i], at, capacity, crc, total, rows.part, rows.next, 0, piece))
                        rows.next += 1
                    if len(held):
                        items.append([(ids_of[i], start, held.copy(), total)])
                    held, full, start = np.empty(0, np.uint32), [], 0
                    if len(items) >= bucket:
                        windows, rest = divided(items, capacity)
                        for w in windows:
                            rows.add(w)
                        items = [rest] if rest else []
            yield pa.RecordBatch.from_arrays(rows.taken(), schema=_ARROW)
        windows, rest = divided(items, capacity)
        for w in windows:
            rows.add(w)
        rows.add(rest, open_=True)
        yield pa.RecordBatch.from_arrays(rows.taken(), schema=_ARROW)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def _next_level(rest: DataFrame, capacity: int, bucket: int, last: bool, with_ids: bool) -> DataFrame:
    """The open windows of every `bucket` tasks divided into full ones; one stays open unless this is the `last` level."""
    def run(table: pa.Table) -> pa.Table:
        by_part: dict[int, list] = {}
        table = table.sort_by([("part", "ascending"), ("offset", "ascending")])
        for r in table.to_pylist():
            by_part.setdefault(r["part"], []).append((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        rows = _Rows(table["group"][0].as_py(), with_ids)
        windows, more = divided(list(by_part.values()), capacity)
        for w in windows:
            rows.add(w)
        rows.add(more, open_=not last)
        return pa.Table.from_arrays(rows.taken(), schema=_ARROW)

    grouped = rest.withColumn("group", F.expr(f"part div {bucket}"))
    return grouped.groupBy("group").applyInArrow(run, _SCHEMA)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, bucket: int = BUCKET, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (binary,
    little-endian unsigned 32-bit) if `with_ids`."""
    level, out = 0, None
    stored = keep(_first_level(docs, tokenizer, capacity, bucket, with_ids), "windows")
    while True:
        number = F.lit(level << (_OWN + _PART)) + F.shiftleft("part", _OWN) + F.col("own")
        placed = stored.where("own IS NOT NULL").withColumn("sequence_id", number)
        out = placed if out is None else out.unionByName(placed)
        rest = stored.where("own IS NULL")
        top = rest.agg(F.max("part")).first()[0]
        if top is None:
            return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
        level += 1
        stored = keep(_next_level(rest, capacity, bucket, top < bucket, with_ids), "windows")


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """The sequences themselves: sequence_id, ids array<int> padded to `capacity` unless their number is a
    power of two, n_tokens, doc_ids by offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))

    def run(batches):
        for batch in batches:
            ids, size, docs_of = [], [], []
            for parts in batch.column("parts").to_pylist():
                own = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                n = len(own)
                ids.append(own if n & (n - 1) == 0 else np.pad(own, (0, capacity - n), constant_values=pad))
                size.append(n)
                docs_of.append([p["doc_id"] for p in parts])
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(size, pa.int64()), pa.array(docs_of, pa.list_(pa.int64()))],
                                             ["sequence_id", "ids", "n_tokens", "doc_ids"])

    placed = pack(docs, tokenizer, capacity, with_ids=True)
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).mapInArrow(run, "sequence_id bigint, ids array<int>, n_tokens bigint, doc_ids array<bigint>")
