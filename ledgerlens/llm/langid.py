"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become lower-case letters with single spaces for everything else, one
before the first and one after the last letter. Their 1-, 2- and 3-grams hash
into `buckets` columns each. Training counts them per language; scoring adds up
a text's rows of the log-probability matrix, a sparse product done in numpy.
Texts are worked on in steps of STEP bytes, long ones in several steps that
hand on their last characters, so memory does not grow with a text.

`keep_identified` also asks whether a text is like the language it was given:
its mean log probability per n-gram must not lie more than SHORTFALL, and three
standard deviations at that length, below the training texts' mean.

All counts, and the means and deviations of `keep_identified`, are taken over
every training text. Bounds: the matrix has 3 * BUCKETS rows of one float per
language and is refused beyond MAX_LANGUAGES, so it is at most 100 MB.

Defined cases: a text that is null or has no letter gets `und` with score 0, as
does every text if nothing could be learned; rows with a null lang or a null
doc_id are not learned from; a blank lang is a language of its own; repeated
rows count each; equal scores go to the first language in alphabetical order;
an empty table gives no rows; extra columns are left alone, but columns named
lang_pred and score are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .staging import with_columns

BUCKETS = 1 << 16
ORDERS = 3
MAX_LANGUAGES = 128
UNDETERMINED = "und"
#: Bytes of text worked on at a time.
STEP = 1 << 17
#: How far below its language's mean a text's log probability per n-gram may lie, in nats,
#: beyond three standard deviations at its length.
SHORTFALL = 3.0
_SPACE = 32
#: Cells that are gathered before they are counted.
_TOGETHER = 1 << 21


@dataclass
class Model:
    """`matrix`: log probabilities, float32[ORDERS * BUCKETS, languages], less their mean `base` over the languages."""

    langs: list[str]
    matrix: np.ndarray
    base: np.ndarray
    prior: np.ndarray


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and their lower case where it is one code point."""
    every = range(sys.maxunicode + 1)
    lower = np.arange(len(every), dtype=np.uint32)
    for i in range(0x20000):
        c = chr(i).lower()
        if len(c) == 1:
            lower[i] = ord(c)
    return np.array([chr(i).isalpha() for i in every], bool), lower


def _steps(texts: list[bytes | None]) -> Iterator[list[tuple[int, bytes, bool, bool]]]:
    """Lists of (text, some of its bytes, whether they are its first, its last) of about STEP bytes."""
    held, size = [], 0
    for i, t in enumerate(texts):
        t, lo, hi = t or b"", 0, -1
        while hi < len(t):
            hi = min(lo + STEP, len(t))
            back = hi
            while back < len(t) and hi - back < 3 and t[back] & 0xC0 == 0x80:
                back -= 1
            hi = back
            if held and size + hi - lo > STEP:
                yield held
                held, size = [], 0
            held.append((i, t[lo:hi], lo == 0, hi == len(t)))
            size += hi - lo
            lo = hi
    if held:
        yield held


def _grams(texts: list[bytes | None], tables) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each step: its texts, which have a letter in it, and for each order (bucket, place of the text
    in the step) of every n-gram. A text's n-grams are the same however it is cut."""
    letter, lower = tables
    carry = ""
    for step in _steps(texts):
        heads = [" " if first else carry for _, _, first, _ in step]
        parts = [h + t.decode(errors="replace") + " " * last for h, (_, t, _, last) in zip(heads, step, strict=True)]
        size = np.array([len(p) for p in parts], np.int64)
        start = np.cumsum(size) - size
        code = lower[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        is_letter = letter[code]
        code[~is_letter] = _SPACE
        # a space stays if it follows a letter or begins its part
        keep = np.ones(len(code), bool)
        keep[1:] = is_letter[1:] | is_letter[:-1]
        keep[start] = True
        before = np.concatenate(([0], np.cumsum(keep)))
        # n-grams that end before `fresh` were counted in the step before
        fresh = before[start + np.array([0 if first else len(h) for h, (_, _, first, _) in zip(heads, step, strict=True)])]
        letters = np.concatenate(([0], np.cumsum(is_letter)))
        has = letters[start + size] > letters[start]
        of = np.repeat(np.arange(len(step)), size)[keep]
        code = code[keep]
        h = np.zeros(len(code), np.uint64)
        found = []
        for n in range(1, ORDERS + 1):
            h = h[:max(len(code) - n + 1, 0)] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:]
            last = np.arange(n - 1, len(code))
            own = (of[:len(h)] == of[n - 1:]) & (last >= fresh[of[n - 1:]])
            bucket = (W.mix(h[own] + np.uint64(n)) >> np.uint64(48)).astype(np.int64) % BUCKETS + (n - 1) * BUCKETS
            found.append((bucket, of[n - 1:][own]))
        if not step[-1][3]:
            tail = code[before[start[-1]]:][1 - ORDERS:]
            carry = "".join(map(chr, tail.tolist()))
        yield np.array([i for i, *_ in step]), has, found


def _usable(docs: DataFrame) -> tuple[dict[str, int], DataFrame]:
    """How many training rows each language has, and their (lang, text)."""
    usable = docs.where("doc_id is not null and lang is not null")
    n_of = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(n_of) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return n_of, usable.select("lang", F.col("text").cast("string"))


def train(docs: DataFrame) -> Model:
    """The model of the non-null languages of `docs` (doc_id, text, lang)."""
    n_of, chosen = _usable(docs)
    langs = sorted(n_of)
    cells_of = ORDERS * BUCKETS
    if not langs:
        return Model([], np.zeros((cells_of, 0), np.float32), np.zeros(cells_of, np.float32), np.zeros(0))
    place = {k: i for i, k in enumerate(langs)}

    def count(batches):
        tables, total, held, n = _tables(), np.zeros(len(langs) * cells_of, np.int64), [], 0
        for batch in batches:
            lang = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for rows, _, found in _grams(W.texts_of(batch.column(1)), tables):
                for bucket, of in found:
                    held.append(lang[rows[of]] * cells_of + bucket)
                    n += len(bucket)
                if n > _TOGETHER:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    cells = chosen.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(langs) * cells_of)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    counts = counts.reshape(len(langs), ORDERS, BUCKETS) + 0.5
    logp = np.log(counts / counts.sum(axis=2, keepdims=True)).reshape(len(langs), -1).T
    base = logp.mean(axis=1)
    prior = np.log(np.array([n_of[k] for k in langs]) / sum(n_of.values()))
    return Model(langs, np.ascontiguousarray(logp - base[:, None], np.float32), base.astype(np.float32), prior)


def _predict(texts, tables, model: Model):
    """For each text: language, its posterior, the sum of its n-grams' log probabilities there, and their number."""
    names, scores = np.empty(len(texts), object), np.zeros(len(texts))
    names[:] = UNDETERMINED
    fit, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    if not model.langs:
        return names, scores, fit, size
    total, has = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), bool)
    for rows, lettered, found in _grams(texts, tables):
        has[rows] |= lettered
        for bucket, of in found:
            if len(bucket):
                first = np.flatnonzero(np.diff(of, prepend=-1))
                into = rows[of[first]]
                total[into] += np.add.reduceat(model.matrix[bucket], first, axis=0, dtype=np.float64)
                fit[into] += np.add.reduceat(model.base[bucket], first, dtype=np.float64)
                size[into] += np.diff(first, append=len(of))
    odds = total + model.prior
    best = odds.argmax(axis=1)
    at = np.arange(len(texts))
    fit += total[at, best]
    odds = np.exp(odds - odds.max(axis=1, keepdims=True))
    scores[has] = (odds[at, best] / odds.sum(axis=1))[has]
    for r in np.flatnonzero(has):
        names[r] = model.langs[best[r]]
    return names, scores, fit, size


def identify(docs: DataFrame, model: Model, with_fit: bool = False) -> DataFrame:
    """`docs` with lang_pred and score added (replacing columns of those names), and _fit and _size if asked for:
    the sum of the n-grams' log probabilities under that language and their number."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index("text")

    def run(batches):
        tables = _tables()
        for batch in batches:
            names, scores, fit, size = _predict(W.texts_of(batch.column(at)), tables, shared.value)
            more = [pa.array(fit), pa.array(size)] if with_fit else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores), *more],
                                             [*batch.schema.names, "lang_pred", "score", *["_fit", "_size"][:len(more)]])

    plain = docs.select(*[F.col(f"`{c}`").cast("string") if c == "text" else F.col(f"`{c}`") for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    more = {"_fit": T.DoubleType(), "_size": T.LongType()} if with_fit else {}
    out = plain.mapInArrow(run, with_columns(plain.schema, lang_pred=T.StringType(), score=T.DoubleType(), **more))
    return out.toDF(*kept, "lang_pred", "score", *more)


def _typical(docs: DataFrame, model: Model) -> dict[str, tuple[float, float, float]]:
    """For each language over its training texts: mean log probability per n-gram, the variance of that mean
    between texts of any length, and the variance of single n-grams."""
    _, chosen = _usable(docs)
    place = {k: i for i, k in enumerate(model.langs)}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        tables, m = _tables(), shared.value
        sums = np.zeros((len(place), 6))
        for batch in batches:
            lang = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            texts = W.texts_of(batch.column(1))
            one, two, size = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
            for rows, _, found in _grams(texts, tables):
                for bucket, of in found:
                    v = (m.matrix[bucket, lang[rows[of]]] + m.base[bucket]).astype(np.float64)
                    for out, x in ((one, v), (two, v * v), (size, np.ones(len(v)))):
                        out += np.bincount(rows[of], x, len(texts))
            some = size > 0
            mean = one[some] / size[some]
            for j, x in enumerate((np.ones(len(mean)), mean, mean**2, 1 / size[some], two[some], size[some])):
                sums[:, j] += np.bincount(lang[some], x, len(place))
        yield pa.RecordBatch.from_arrays([pa.array(list(place)), *(pa.array(sums[:, j]) for j in range(6))], ["lang", *"abcdef"])

    got = chosen.mapInArrow(run, "lang string, " + ", ".join(f"{c} double" for c in "abcdef")).groupBy("lang").agg(*[F.sum(c).alias(c) for c in "abcdef"]).collect()
    out = {}
    for r in got:
        if r["a"]:
            mean = r["b"] / r["a"]
            single = max(r["e"] / r["f"] - mean**2, 0.0)
            # what texts differ by beyond the noise of their own n-grams
            out[r["lang"]] = (mean, max(r["c"] / r["a"] - mean**2 - single * r["d"] / r["a"], 0.0), single)
    return out


def held_out(docs: DataFrame, folds: int, fold: int):
    """Whether crc32(doc_id as text) mod `folds` is `fold`; a null doc_id is held out."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % folds == fold, F.lit(True))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows not held out."""
    slim = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(docs, 3, 1))
    model = train(slim.where("not held_out"))
    return identify(slim.select("doc_id", "held_out", "text"), model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.5, shortfall: float = SHORTFALL) -> DataFrame:
    """The rows of `docs` whose language is determined with a posterior of at least `least` and whose text is
    like the texts of that language: not more than `shortfall` nats and three standard deviations below
    their mean log probability per n-gram. The model is learned from their own non-null lang; if there is none, every row
    stays."""
    slim = docs.select("doc_id", "text", "lang")
    model = train(slim)
    if not model.langs:
        return docs
    typical = _typical(slim, model)
    mean, between, single = (F.create_map(*[F.lit(x) for k, v in typical.items() for x in (k, v[j])])[F.col("lang_pred")] for j in range(3))
    lowest = mean - shortfall - 3 * F.sqrt(between + single / F.greatest("_size", F.lit(1)))
    names = docs.columns
    plain = docs.toDF(*["text" if c == "text" else f"k{i}" for i, c in enumerate(names)])
    found = identify(plain, model, with_fit=True)
    like = F.col("_fit") / F.greatest("_size", F.lit(1)) >= lowest
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least) & F.coalesce(like, F.lit(True))).select(*plain.columns).toDF(*names)
