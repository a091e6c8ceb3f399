"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's features are hashed byte 1-, 2- and 3-grams, log-scaled, weighted by
inverse document frequency and scaled to length 1. A truncated SVD of the
labelled sample gives the projection to RANK dimensions. Projection and
labelled vectors go to the workers; every document's cosine with every labelled
vector is computed exactly, a block of documents at a time, and the labels of
the K nearest vote with their cosines as weights.

Bound: the model is fitted on at most about SAMPLE labelled rows, chosen by a
hash of doc_id; it holds FEATURES * RANK + SAMPLE * RANK numbers (3 MB).

Defined cases: null and empty texts, and texts without positive cosine to any
labelled one, get the share of label 1 in the sample; a document with several
labels has their mean, rounded up; null labels and ids are not learned from; if
there are no labels every score is 0.5. Repeated rows are scored each. Texts are
taken whole, a very long one as a piece of work of its own; of neighbours with
equal cosines any may be the last to vote; an empty table gives no rows; columns
with other names are left alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .langid import held_out
from .staging import with_columns

SAMPLE = 4000
FEATURES = 1 << 13
RANK = 64
K = 15
_BLOCK = 128


def _features(texts: list[bytes | None]) -> np.ndarray:
    """log(1 + count) of each hashed byte n-gram, a row for each text."""
    at = np.cumsum([0, *(len(t or b"") for t in texts)])
    code = np.frombuffer(b"".join([t or b"" for t in texts]), np.uint8).astype(np.uint32)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    total = np.zeros(len(texts) * FEATURES)
    h = np.zeros(len(code), np.uint32)
    for n in range(1, 4):
        last = max(len(code) - n + 1, 0)
        h = h[:last] * np.uint32(0x01000193) + code[n - 1:] + np.uint32(n)
        x = h * np.uint32(0x9E3779B1)
        one = doc[:last] == doc[n - 1:]
        cell = doc[:last] * FEATURES + ((x ^ (x >> np.uint32(15))) >> np.uint32(4)) % FEATURES
        total += np.bincount(cell[one], minlength=len(total))
    return np.log1p(total).astype(np.float32).reshape(len(texts), FEATURES)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _blocks(texts):
    """Row ranges of at most _BLOCK texts and PIECE bytes."""
    for lo, hi in W.pieces(texts):
        for a in range(lo, hi, _BLOCK):
            yield a, min(a + _BLOCK, hi)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK):
    """(projection, labelled vectors, labels) from the rows of `docs` (doc_id, text) that have a label."""
    marked = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
              .agg(F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("quality")))
    n = marked.count()
    chosen = marked.where(F.xxhash64("doc_id") <= min(1.0, sample / max(n, 1)) * 2.0**64 - 2.0**63)

    def run(batches):
        for batch in batches:
            texts = W.texts_of(batch.column(0))
            for lo, hi in _blocks(texts):
                rows = [r.astype(np.float16).tobytes() for r in _features(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1).slice(lo, hi - lo), pa.array([zlib.crc32(r) for r in rows], pa.int64())], ["x", "y", "place"])

    # the hash keeps about `sample` ids of 8 bytes, so this side is small
    table = (docs.join(F.broadcast(chosen), "doc_id").select(F.col("text").cast("string"), "quality")
             .mapInArrow(run, "x binary, y int, place bigint").toArrow())
    order = np.argsort(table["place"].to_numpy(), kind="stable")
    y = table["y"].to_numpy()[order].astype(np.float64)
    x = np.empty((len(y), FEATURES), np.float32)
    at = np.empty(len(y), np.int64)
    at[order] = np.arange(len(y))
    for i, row in zip(at, table["x"], strict=True):
        x[i] = np.frombuffer(row.as_buffer(), np.float16)
    del table
    idf = np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))).astype(np.float32) + 1
    x *= idf
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.where(size > 0, size, 1)[:, None]
    rank = min(rank, *x.shape)
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(x.T @ (x @ rng.standard_normal((FEATURES, rank + 16), np.float32)))[0] if len(x) else np.zeros((FEATURES, 0), np.float32)
    for _ in range(2):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, turn = np.linalg.eigh((x @ basis).T @ (x @ basis))
    projection = (basis @ turn[:, ::-1][:, :rank]).astype(np.float32)
    return idf[:, None] * projection, _unit(x @ projection), y


def _votes(texts, model, k):
    projection, known, y = model
    prior = y.mean() if len(y) else 0.5
    out = np.full(len(texts), prior)
    if not len(y):
        return out
    k = min(k, len(y))
    for lo, hi in _blocks(texts):
        cosine = _unit(_features(texts[lo:hi]) @ projection) @ known.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        out[lo:hi] = np.where(total > 0, (weight * y[near]).sum(axis=1) / np.where(total > 0, total, 1), prior)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model, k: int = K) -> DataFrame:
    """`docs` with the column score added (a column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    at = kept.index("text")

    def run(batches):
        for batch in batches:
            got = _votes(W.texts_of(batch.column(at)), shared.value, k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*batch.schema.names, "score"])

    plain = docs.select(*[F.col(f"`{c}`").cast("string") if c == "text" else F.col(f"`{c}`") for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    return plain.mapInArrow(run, with_columns(plain.schema, score=T.DoubleType())).toDF(*kept, "score")


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, learned from labels of the rows not held out."""
    slim = docs.select("doc_id", "text")
    learn = labels.select("doc_id", "quality").where(~held_out(labels, 5, 0))
    scored = score(slim.withColumn("held_out", held_out(slim, 5, 0)), fit(slim, learn))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
