"""Link operators: key/value metadata lookups (J4, J6) and the text
containment join (J17).

Containment join
----------------
`sales left join paydowns on paydowns.description like '%' || sales.source_id || '%'`
is a theta join; planned as is it becomes a nested loop over every pair.
Here it is made an equi join without losing any match:

* In LIKE, `_` inside the key matches any single character and `%` any run,
  so every maximal run of other characters of the key must occur in the text,
  and so must every piece (gram) of such a run.
* Grams have one of the fixed lengths GRAMS; a key takes the longest that its
  longest run has room for, and up to TRIED grams of that run. The lengths lie
  close together, so that a gram leaves out little of its run: of the numbers of
  seven digits few texts hold the same six, but one in two hundred the same three.
  Each text is cut into its distinct grams of the lengths that keys take, a number
  linear in the text. A key without a literal character has the empty gram, as has
  every text.
* Texts are counted per (partition key, gram). A key one of whose grams occurs
  in no text matches none; the others are looked up by their rarest gram alone.
  The original LIKE decides on each such pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths of grams in the containment join.
GRAMS = (16, 12, 8, 6, 4, 3, 2, 1, 0)
#: Grams of a key that are tried.
TRIED = 4
#: A key with more than one part in PARTS of all rows is split.
PARTS = 4096


def metadata_value(meta: DataFrame, key: str, id_col: str, out: str) -> DataFrame:
    """Prefilter a (parent_id, key, value) relation on one key: (id, value)."""
    return meta.where(F.col("key") == key).select(F.col(id_col).alias("_parent"),
                                                  F.col("value").alias(out))


def heavy_keys(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """(_hot, _copies): the keys with more than 1/`parts` of the rows of `df`, and into how many copies
    each must be split so that none has more. At most `parts` rows, whatever the data."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    return heaviest(counts, parts)


def heaviest(counts: DataFrame, parts: int = PARTS) -> DataFrame:
    """`heavy_keys` from a relation of counts (_hot, _n), one row per key."""
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * parts > total).select("_hot", F.ceil(F.col("_n") * parts / total).cast("int").alias("_copies"))


def lookup(df: DataFrame, dim: DataFrame, key: str, row: list[str], heavy: DataFrame | None = None) -> DataFrame:
    """`df` left join `dim` on the column `key` of both, safe for null and hot keys.

    Rows without a key get one of their own that matches nothing (from the
    columns `row`), so they spread over all reducers. With `heavy` (a result of
    `heavy_keys`), a key listed there is repeated in `dim` by its number of
    copies, and the rows of `df` with that key are dealt over them by a hash of
    `row`; other keys are not repeated. The list is bounded by its making, so
    it is broadcast.
    """
    of_row = F.xxhash64(*row)
    left = F.coalesce(F.col(key), F.concat(F.lit("\u0001"), of_row.cast("string")))
    dim = dim.withColumnRenamed(key, "_dim_key")
    if heavy is None:
        return df.join(dim, left == F.col("_dim_key"), "left").drop("_dim_key")
    copies = F.coalesce("_copies", F.lit(1))
    dim = (dim.join(F.broadcast(heavy), F.col("_dim_key") == F.col("_hot"), "left")
           .withColumn("_dim_copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_hot", "_copies"))
    df = (df.join(F.broadcast(heavy), F.col(key) == F.col("_hot"), "left")
          .withColumn("_copy", F.pmod(of_row, copies).cast("int")).drop("_hot", "_copies"))
    return df.join(dim, (left == F.col("_dim_key")) & (F.col("_copy") == F.col("_dim_copy")), "left").drop("_dim_key", "_dim_copy", "_copy")


def _literal_run(key: str) -> Column:
    """The longest run of literal characters of a LIKE key (the last one on ties), '' if it has none."""
    runs = F.split(F.col(key), r"[%_\\\\]+")
    best = F.array_max(F.transform(runs, lambda x, i: F.struct(F.length(x).alias("n"), i.alias("i"), x.alias("s"))))
    return best.getField("s")


def _grams_of_run(run: Column) -> Column:
    """Up to TRIED grams of the run, spread over it, the last one included."""
    size = F.length(run)

    def spread(n: int) -> Column:
        starts = F.transform(F.sequence(F.lit(0), F.lit(TRIED - 1)), lambda i: F.floor((size - n) * i / (TRIED - 1)).cast("int"))
        return F.array_distinct(F.transform(starts, lambda i: F.substring(run, i + 1, F.lit(n))))

    out = F.array(F.lit(""))
    for n in sorted(g for g in GRAMS if g):
        out = F.when(size >= n, spread(n)).otherwise(out)
    return out


def _cuts(text: str, n: int) -> Column:
    """All substrings of n characters, in order."""
    if n == 0:
        return F.array(F.lit(""))
    starts = F.sequence(F.lit(1), F.length(text) - F.lit(n - 1))
    return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substring(F.col(text), i, n))) \
            .otherwise(F.array().cast("array<string>"))


def _text_grams(text: str, sizes: Column) -> Column:
    """The distinct grams of the text of the lengths in the array `sizes`."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.when(F.array_contains(sizes, F.lit(n)), _cuts(text, n)).otherwise(none) for n in GRAMS]))


def _candidates(keys: DataFrame, right: DataFrame, key: str, right_id: str, text: str, parts: list[str]) -> DataFrame:
    """`parts`, `_key` and `right_id` of each distinct key of `keys` and each text that has the key's rarest gram."""
    keys = keys.where(F.col(key).isNotNull()).select(*parts, F.col(key).alias("_key")).distinct()
    keyed = keys.withColumn("_grams", _grams_of_run(_literal_run("_key")))
    # the lengths that keys take, at most len(GRAMS) values; read with all columns, so that the keys are made distinct once
    sizes = keyed.agg(F.collect_set(F.length(F.element_at("_grams", 1))).alias("sizes"), F.bit_xor(F.xxhash64(*parts, "_key")).alias("whole"))
    sizes = sizes.select(F.struct("sizes", "whole")).scalar().getField("sizes")
    texts = (right.where(F.col(text).isNotNull() & F.col(right_id).isNotNull()).select(*parts, right_id, F.explode(_text_grams(text, sizes)).alias("_gram"))
             .repartition(*parts, "_gram"))
    # counts ids, so that the shuffle of `texts` serves here and below
    seen = texts.groupBy(*parts, "_gram").agg(F.count(right_id).alias("_n"))
    tried = keyed.select(*parts, "_key", F.size("_grams").alias("_tried"), F.explode("_grams").alias("_gram"))
    rarest = (tried.join(seen, [*parts, "_gram"]).groupBy(*parts, "_key", "_tried")
              .agg(F.count(F.lit(1)).alias("_found"), F.min(F.struct("_n", "_gram")).alias("_rare"))
              .where("_found = _tried").select(*parts, "_key", F.col("_rare._gram").alias("_gram")))
    return rarest.join(texts, [*parts, "_gram"]).drop("_gram")


def _text_matches(keys: DataFrame, right: DataFrame, key: str, right_id: str, text: str, parts: list[str]) -> DataFrame:
    """`parts`, `_key` and the columns of `right` for each distinct key of `keys` and each text that it matches."""
    pairs = _candidates(keys, right, key, right_id, text, parts)
    return pairs.join(right.drop(*parts), right_id).where(F.expr(f"`{text}` like concat('%', `_key`, '%')"))


def contains_join(left: DataFrame, right: DataFrame, left_id: str, left_key: str,
                  right_id: str, text_col: str, partition_cols=(), keys: DataFrame | None = None) -> DataFrame:
    """Left join `left` to `right` where right.text like '%' || left.key || '%'.

    `left_id` / `right_id` must be unique row ids. Matching is restricted to
    equal `partition_cols` (e.g. the merchant) on both sides. `keys` holds the
    keys and partition columns of `left` if they can be had without making
    `left` itself, which is then made once.
    Returns left's columns plus right's columns (right columns null when
    nothing matched).
    """
    parts = list(partition_cols)
    found = _text_matches(left if keys is None else keys, right, left_key, right_id, text_col, parts)
    found = found.select(*[F.col(c).alias(f"_m_{c}") for c in parts], F.col("_key").alias("_found_key"), *[c for c in right.columns if c not in parts])
    # a row without a key has one of its own that matches nothing
    own = F.coalesce(F.col(left_key), F.concat(F.lit("\u0001"), F.xxhash64(left_id).cast("string")))
    on = own == F.col("_found_key")
    for c in parts:
        on = on & (F.col(c) == F.col(f"_m_{c}"))
    return left.join(found, on, "left").select(*left.columns, *[c for c in right.columns if c not in parts])
