"""Best-fit decreasing packing of tokenised documents into sequences.

Tokens: every run of text between ASCII white space is encoded on its own (the
tokenizer's normaliser and splitter never look across white space), so each
task encodes a distinct run once and assembles documents by indexing.

Packing: best-fit decreasing takes documents by falling length and puts each
into the open bin with the least room that holds it. Documents of one length
are interchangeable, so the order of placements depends on the histogram of
lengths alone: at most `capacity` numbers however large the corpus. The driver
runs best fit over that histogram with whole runs of equal documents and equal
bins; a segment tree over the remaining capacities gives the tightest open
class of bins in logarithmic time. Each piece then finds its bin by its rank
among the pieces of its length, which comes from per-partition counts.

Defined cases: a null text is empty and gives the end token alone; repeated
rows are packed each; a null doc_id is kept; only texts of more than
`capacity` tokens are cut; an empty table gives no rows; texts are taken whole,
a very long one as a piece of work of its own; pieces of equal length are placed
by partition and place in it; columns other than doc_id and text are left alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .staging import keep, with_columns

CAPACITY = 4096
#: Distinct runs of text that a task remembers the tokens of.
REMEMBERED = 1 << 20
#: Runs that are encoded in one call.
_RUNS = 1024
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Encoder:
    """Token ids of runs of text, by hash, for the runs seen so far in this task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.loaded, self.tokenizer = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # without special tokens to look for it is faster; texts that hold one go to the other
        self.tokenizer.encode_special_tokens = True
        self.special = [t.content for t in self.loaded.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self):
        self.hash, self.start, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _encoded(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs, encoded as one text, and how many each has by where they start in it."""
        text = " ".join(runs)
        got = (self.loaded if any(t in text for t in self.special) else self.tokenizer).encode(text, add_special_tokens=False)
        first = np.cumsum([0, *(len(r) + 1 for r in runs[:-1])])
        at = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
        return np.array(got.ids, np.uint32), np.bincount(np.searchsorted(first, at, "right") - 1, minlength=len(runs))

    def ids_of(self, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each word has."""
        if len(self.hash) > REMEMBERED:
            self.forget()
        seen, one, back = np.unique(w.hash, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hash, seen), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != seen) if len(self.hash) else np.arange(len(seen))
        if len(new):
            text = w.raw.tobytes()
            runs = [text[a:b].decode() for a, b in zip(w.start[one[new]].tolist(), w.end[one[new]].tolist(), strict=True)]
            parts = [self._encoded(runs[i:i + _RUNS]) for i in range(0, len(runs), _RUNS)]
            flat, size = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used:self.used + len(flat)] = flat
            start = self.used + np.cumsum(size) - size
            self.used += len(flat)
            into = np.searchsorted(self.hash, seen[new])
            self.hash = np.insert(self.hash, into, seen[new])
            self.start, self.size = np.insert(self.start, into, start), np.insert(self.size, into, size)
            at = np.searchsorted(self.hash, seen)
        start, size = self.start[at][back], self.size[at][back]
        total = int(size.sum())
        place = np.arange(total) + np.repeat(start - (np.cumsum(size) - size), size)
        return self.ids[place], size


def _token_ids(texts, encoder):
    """For each text its token ids, the end token included, as views of one array."""
    for lo, hi in W.pieces(texts):
        w = W.words(texts[lo:hi], W.SPACED)
        ids, size = encoder.ids_of(w)
        at = np.concatenate(([0], np.cumsum(size)))[w.first]
        for d in range(hi - lo):
            yield np.append(ids[at[d]:at[d + 1]], np.uint32(1))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` tokens, with the partition that made them
    (`part`) and their rank among its pieces of the same length (`nth`)."""
    def run(batches):
        encoder, seen = _Encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), _token_ids(W.texts_of(batch.column(1)), encoder), strict=True):
                for k, start in enumerate(range(0, len(ids), capacity)):
                    mine = ids[start:start + capacity].astype("<u4").tobytes()
                    n = len(mine) // 4
                    rows.append((doc, k, start, n, zlib.crc32(mine), part, int(seen[n]), *[mine] * with_ids))
                    seen[n] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()][:7 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 [*_NAMES[:7 + with_ids]])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, _PIECES + ", part bigint, nth bigint" + ", ids binary" * with_ids)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]


class _Open:
    """Segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, room: int, value: bool):
        i = room + self.leaves
        self.any[i] = value
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int:
        """The smallest room >= least with an open bin, or -1."""
        i = least + self.leaves
        while not self.any[i]:
            while i & 1:
                i >>= 1
            if i == 0:
                return -1
            i += 1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over {length: number of documents}.

    Rows (length, rank, count, bin, offset): the documents of that length with
    ranks rank..rank+count-1 go to the bins bin, bin+1, ... at that offset.
    """
    open_, bins, moves, next_bin = _Open(capacity), {}, [], 0

    def put(room, first, count):
        if room and count:
            bins.setdefault(room, []).append((first, count))
            open_.set(room, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = open_.tightest(length)
            if room < 0:  # new bins
                room, first, count = capacity, next_bin, -(-left // (capacity // length))
                next_bin += count
            else:
                first, count = bins[room].pop()
                if not bins[room]:
                    open_.set(room, False)
            # a bin that took one document is now the tightest, so it takes as many as fit
            fit = room // length
            full = min(count, left // fit)
            rest = left - full * fit if full < count else 0
            for slot in range(fit):
                if full + (slot < rest):
                    moves.append((length, rank, full + (slot < rest), first, capacity - room + slot * length))
                    rank += full + (slot < rest)
            used = full + (rest > 0)
            put(room - fit * length, first, full)
            put(room - rest * length, first + full, int(rest > 0))
            put(room, first + used, count - used)
            left -= full * fit + rest
    return moves


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the rows of `token_pieces` (a stored table)."""
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    moves = sorted(best_fit(histogram, capacity))
    plan = pieces.sparkSession.sparkContext.broadcast(np.array(moves, np.int64).reshape(-1, 5))
    ranked = pieces.join(ranks, ["length", "part"]).withColumn("_rank", F.col("_before") + F.col("nth")).drop("part", "nth", "_before")
    names = [c for c in pieces.columns if c not in ("part", "nth")]

    def run(batches):
        length, rank, _, first, offset = plan.value.T
        key = length << 48 | rank
        for batch in batches:
            mine_length, mine = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(key, mine_length << 48 | mine, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(first[at] + mine - rank[at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, with_columns(pieces.select(*names).schema, sequence_id=T.LongType(), offset=T.LongType()))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(keep(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, ids array<int> (at most `capacity`), doc_ids by offset."""
    placed = pack(keep(token_pieces(docs, tokenizer, capacity, with_ids=True), "pieces"), capacity)
    by_offset = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))

    def run(batches):
        for batch in batches:
            parts = batch.column("parts").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array([np.frombuffer(b"".join(p["ids"] for p in x), "<u4").astype(np.int32) for x in parts], pa.list_(pa.int32())),
                 pa.array([[p["doc_id"] for p in x] for x in parts], pa.list_(pa.int64()))], ["sequence_id", "ids", "doc_ids"])

    return (placed.groupBy("sequence_id").agg(by_offset.alias("parts"))
            .mapInArrow(run, "sequence_id bigint, ids array<int>, doc_ids array<bigint>"))
