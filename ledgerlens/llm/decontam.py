"""Benchmark decontamination by a broadcast hash set of word n-grams.

Words are lower-cased runs of letters, digits and non-ASCII characters. Each
benchmark item gives its windows of `n` words, or all its words as one window
if it has fewer. The windows' hashes go to the workers; they slide over the
words of every whole document, look each window up, compare the words of every
hit with the item's, and mark the words inside.

Size: the windows are dealt into blocks of at most BLOCK windows by hash. Each
block is broadcast on its own and scanned for in its own pass over the rows,
so no broadcast grows with the benchmark.

Defined cases: a null or empty text has no words; an item without words gives
no window; a null item id marks words but is not listed; item ids that occur
twice count once; extra columns of either table are left alone. An empty
benchmark marks nothing. Repeated documents are judged each. Texts are taken
whole; one longer than `words.PIECE` is a piece of work of its own, so a task's
memory follows the longest text. Nothing is ranked, so there are no ties.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .staging import keep

#: Windows of a benchmark that are broadcast at once (about 30 MB).
BLOCK = 1 << 18
_LUT_BITS = 22


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The windows: hash, size in words, the words themselves, item_id."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), W.texts_of(batch.column(1))
            for lo, hi in W.pieces(texts):
                w = W.words(texts[lo:hi], W.ALNUM)
                rows = []
                for d in range(hi - lo):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    size = min(n, b - a)
                    rows += [(size, w.bytes_of(i, i + size), ids[lo + d]) for i in range(a, b - size + 1) if size]
                if rows:
                    size, gram, item = map(list, zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(size, pa.int32()), pa.array(gram, pa.binary()), pa.array(item, pa.string())],
                        ["size", "gram", "item"])

    return (benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
            .mapInArrow(run, "size int, gram binary, item string").distinct())


def _block(rows):
    """Sizes, sorted hashes and {words: item ids} of a block of windows, as it is broadcast."""
    items: dict[bytes, set] = {}
    for r in rows:
        items.setdefault(bytes(r.gram), set()).update(() if r.item is None else (r.item,))
    sizes, grams = sorted({r.size for r in rows}), list(items)
    hashes = np.empty(len(grams), np.uint64)
    w = W.words(grams, W.ALNUM)
    for size in sizes:
        h, place = W.grams(w, size)
        whole = np.diff(w.first)[w.doc[place]] == size
        hashes[w.doc[place[whole]]] = h[whole]
    return sizes, np.unique(hashes), items


def _find(w: W.Words, sizes, hashes, items, lut):
    """(first word, size, items) of each occurrence of a window."""
    for size in sizes:
        h, place = W.grams(w, size)
        near = np.flatnonzero(lut[h >> np.uint64(64 - _LUT_BITS)])
        at = np.minimum(np.searchsorted(hashes, h[near]), len(hashes) - 1)
        for i in place[near[hashes[at] == h[near]]].tolist():
            found = items.get(w.bytes_of(i, i + size))
            if found is not None:
                yield i, size, found


def _mark(docs: DataFrame, block, n_cols: int) -> DataFrame:
    """Add the block's hits to the columns _spans (first word, size, ...) and _items."""
    def run(batches):
        sizes, hashes, by_words = block.value
        lut = np.zeros(1 << _LUT_BITS, bool)  # most hashes are refused by their first bits
        lut[hashes >> np.uint64(64 - _LUT_BITS)] = True
        for batch in batches:
            texts = W.texts_of(batch.column(n_cols))
            spans, items = batch.column(n_cols + 1).to_pylist(), batch.column(n_cols + 2).to_pylist()
            for lo, hi in W.pieces(texts):
                w = W.words(texts[lo:hi], W.ALNUM)
                for i, size, found in _find(w, sizes, hashes, by_words, lut):
                    d = int(w.doc[i])
                    spans[lo + d] += [i - int(w.first[d]), size]
                    items[lo + d] = [*{*items[lo + d], *found}]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_cols + 1], pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def marked(docs: DataFrame, benchmark: DataFrame, n: int = 10, block: int = BLOCK) -> DataFrame:
    """`docs` as struct columns c0, c1, ... plus _text, _spans and _items."""
    spark = docs.sparkSession
    windows = keep(benchmark_windows(benchmark, n), "windows")
    blocks = -(-windows.count() // block)
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    out = docs.select(*cols, docs["text"].cast("string").alias("_text"),
                      F.array().cast("array<bigint>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    for k in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k).collect()
        if rows:
            out = _mark(out, spark.sparkContext.broadcast(_block(rows)), len(cols))
    return out


def _hit_words(w: W.Words, spans: list[list[int]]) -> np.ndarray:
    hit = np.zeros(len(w.start) + 1, np.int64)
    for d, s in enumerate(spans):
        if s:
            first = np.asarray(s[0::2]) + w.first[d]
            np.add.at(hit, first, 1)
            np.add.at(hit, first + np.asarray(s[1::2]), -1)
    return np.cumsum(hit)[:-1] > 0


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    def run(batches):
        for batch in batches:
            texts, spans, items = W.texts_of(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            n_words, n_hit = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for lo, hi in W.pieces(texts):
                w = W.words(texts[lo:hi], W.ALNUM)
                n_words[lo:hi] = np.diff(w.first)
                n_hit[lo:hi] = np.bincount(w.doc[_hit_words(w, spans[lo:hi])], minlength=hi - lo)
            sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()),
                 pa.array(sha), pa.array(n_hit > 0)],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return (marked(docs.select("doc_id", "text"), benchmark, n, block).select("c0", "_text", "_spans", "_items")
            .mapInArrow(run, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", share: float = 0.0,
                  block: int = BLOCK) -> DataFrame:
    """`docs` without contamination, with their own columns.

    remove="documents" drops a document if more than `share` of its words are
    hit; remove="spans" cuts every run of hit words out of the text, with the
    white space and marks between those words, and keeps the document.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    names, n_cols = docs.columns, len(docs.columns)
    text_at = names.index("text")
    out = marked(docs, benchmark, n, block)

    def run(batches):
        for batch in batches:
            texts, spans = W.texts_of(batch.column(n_cols)), batch.column(n_cols + 1).to_pylist()
            stays = np.ones(len(texts), bool)
            for lo, hi in W.pieces(texts):
                if not any(spans[lo:hi]):
                    continue
                w = W.words(texts[lo:hi], W.ALNUM)
                hit = _hit_words(w, spans[lo:hi])
                at = np.cumsum([0, *(len(t or b"") + 1 for t in texts[lo:hi])])
                for d in range(hi - lo):
                    mine = hit[w.first[d]:w.first[d + 1]]
                    if remove == "documents":
                        stays[lo + d] = mine.sum() <= share * len(mine)
                    elif mine.any():
                        start, end = w.start[w.first[d]:w.first[d + 1]] - at[d], w.end[w.first[d]:w.first[d + 1]] - at[d]
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], mine, [0]))))
                        cut, pos = [], 0
                        for a, b in zip(edge[0::2], edge[1::2], strict=True):
                            cut.append(texts[lo + d][pos:start[a]])
                            pos = end[b - 1]
                        texts[lo + d] = b"".join([*cut, texts[lo + d][pos:]])
            columns = list(batch.columns[:n_cols])
            if remove == "spans":
                columns[text_at] = pa.array([None if t is None else t.decode() for t in texts], batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:n_cols]).filter(pa.array(stays))

    schema = out.select(*[f"c{i}" for i in range(n_cols)]).schema
    out = out.mapInArrow(run, schema)
    return out.toDF(*names)
