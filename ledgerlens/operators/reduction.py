"""Reduction of a large table by the keys of a small side, before any shuffle.

A left join to a large table shuffles all of it, though only the rows with a
key of the left side can meet one. The keys' hashes become a set of BITS bits,
made inside the plan as a scalar subquery (partial bit_or per task, one array of
longs at the end), and the large table drops at its scan every row whose bit is
not set. A row that could match is never dropped; the join that follows is the
exact one. The set has a fixed size: with far more keys than bits it lets all
rows pass and costs one bit test per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key set: 2 MB.
BITS = 1 << 24


def _slot(key: Column, bits: int) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def key_bits(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """Scalar subquery: the set of the non-null values of `key` as an array of bits / 64 longs."""
    word, bit = _slot(F.col(key), bits)
    used = (keys.where(F.col(key).isNotNull()).groupBy(word.alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("set")))
    # words that no key has are 0
    full = keys.sparkSession.range(bits >> 6).withColumnRenamed("id", "word").join(used, "word", "left")
    words = full.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set")))).alias("words"))
    return words.select(F.transform("words", lambda w: w["set"])).scalar()


def maybe_in(key: Column, bits_of: Column, bits: int = BITS) -> Column:
    """Whether `key` can be among the keys of `key_bits`; false only for keys that are not, or null."""
    word, bit = _slot(key, bits)
    held = F.element_at(bits_of, (word + 1).cast("int"))
    return key.isNotNull() & (F.call_function("shiftright", held, bit).bitwiseAND(F.lit(1)) == 1)


def reduced(large: DataFrame, large_key: str, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows of `large` whose `large_key` can be among the values of `key` in `keys`."""
    return large.where(maybe_in(F.col(large_key), key_bits(keys, key, bits), bits))
