"""WARC fixity audit with Merkle trees.

Records are hashed (SHA-256 of their bytes); the records that start in one
offset range of an archive are hashed in order of offset into a node, and 16
neighbouring ranges into a node one level up, until one node covers the
archive: ranges of 2**16, 2**20, 2**24, 2**28 and 2**32 bytes. A tree depends
on offsets and bytes alone, so two replicas of an archive are compared by their
roots, and only below nodes that differ are children compared, down to the
records that are changed, missing or extra.

`warc_records` writes pages as WARC/1.1 response records; `laid_out` deals them
in order of (page_id, url, hash) into archives of RECORDS records and gives
each its offset. The order's ranks come from a range partitioning and counts
per partition, so no task sees more than its range; equal rows may share an
archive boundary in any order, their bytes are the same.

Archives are at most 4 GiB: RECORDS pages, or an error from `tree` beyond.
Defined cases: null url or html counts as empty, a null page_id sorts first and
is written as an empty id; repeated pages are records of their own; an empty
table has no archives; an archive that only one replica has differs at its root;
records are whole, and an archive of over 4 GiB is refused; columns with other
names are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import keep

RECORDS = 1024
#: log2 of the bytes of a node's range, from the leaves to the root.
LEVELS = (16, 20, 24, 28, 32)


def warc_records(pages: DataFrame) -> DataFrame:
    """page_id, url, record: the bytes of a WARC response record for every page."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), text("page_id"), F.lit(">\r\nWARC-Target-URI: "), text("url"),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(text("html")).cast("string"), F.lit("\r\n\r\n"))
    return pages.select("page_id", "url", F.concat(head, text("html"), F.lit("\r\n\r\n")).alias("record"))


def laid_out(records: DataFrame, per_archive: int = RECORDS) -> DataFrame:
    """`records` (page_id, url, hash, size, ...; a stored table) with archive and offset."""
    ranged = keep(records.withColumn("_salt", F.monotonically_increasing_id())
                  .repartitionByRange("page_id", "url", "hash", "_salt").withColumn("_part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as there are partitions
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    here = Window.partitionBy("_part").orderBy(F.col("page_id").asc_nulls_first(), F.col("url").asc_nulls_first(), "hash", "_salt")
    rank = F.col("_before") + F.row_number().over(here) - 1
    placed = ranged.join(before, "_part").withColumn("_rank", rank).withColumn("archive", F.floor(F.col("_rank") / per_archive).cast("bigint"))
    ahead = Window.partitionBy("archive").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("size").over(ahead), F.lit(0)).cast("bigint")).drop("_salt", "_part", "_before", "_rank")


def tree(records: DataFrame) -> DataFrame:
    """Nodes of every archive's tree over `records` (archive, offset, hash): archive, level
    (0: offset ranges of 64 KiB ... 4: root), node (number of the range), hash; a stored table."""
    joined = lambda c, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, c))), lambda x: F.concat_ws(":", x[by].cast("string"), x[c])), ",")
    over = F.col("offset") >= 1 << LEVELS[-1]
    level = (records.withColumn("offset", F.when(over, F.raise_error(F.lit("an archive is larger than 4 GiB"))).otherwise(F.col("offset")).cast("bigint"))
             .groupBy("archive", F.shiftright("offset", LEVELS[0]).alias("node")).agg(F.sha2(joined("hash", "offset"), 256).alias("hash")))
    nodes = [keep(level.select("archive", F.lit(0).alias("level"), "node", "hash"), "nodes")]
    for i in range(1, len(LEVELS)):
        up = (nodes[-1].groupBy("archive", F.shiftright("node", LEVELS[i] - LEVELS[i - 1]).alias("up")).agg(F.sha2(joined("hash", "node"), 256).alias("hash")))
        nodes.append(keep(up.select("archive", F.lit(i).alias("level"), F.col("up").alias("node"), "hash"), "nodes"))
    out = nodes[0]
    for x in nodes[1:]:
        out = out.unionByName(x)
    return out


def _differing(ours: DataFrame, theirs: DataFrame, on: list[str]) -> tuple[DataFrame, Column]:
    """Full join of two sides with the column `hash`, and whether they differ."""
    both = ours.withColumnRenamed("hash", "ours").join(theirs.withColumnRenamed("hash", "theirs"), on, "full")
    return both, ~F.col("ours").eqNullSafe(F.col("theirs"))


def audit(records: DataFrame, replica: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare two replicas (archive, offset, hash; stored tables).

    Returns the roots (archive, root, replica_root; null: not there), the
    records that differ (archive, offset, ours, theirs), and the nodes compared
    on the way down (archive, level, node).
    """
    mine, other = tree(records), tree(replica)
    at = lambda t, i: t.where(F.col("level") == i).select("archive", "node", "hash")
    top = len(LEVELS) - 1
    both, differ = _differing(at(mine, top), at(other, top), ["archive", "node"])
    roots = keep(both, "roots")
    compared = [roots.select("archive", F.lit(top).alias("level"), "node")]
    bad = roots.where(differ).select("archive", "node")
    for i in range(top - 1, -1, -1):
        # only the children of nodes that differ are looked at
        shift = LEVELS[i + 1] - LEVELS[i]
        below = lambda t: at(t, i).withColumn("up", F.shiftright("node", shift)).join(bad.withColumnRenamed("node", "up"), ["archive", "up"], "left_semi").drop("up")  # noqa: B023, E731
        both, differ = _differing(below(mine), below(other), ["archive", "node"])
        both = keep(both, "compared")
        compared.append(both.select("archive", F.lit(i).alias("level"), "node"))
        bad = both.where(differ).select("archive", "node")
    inside = lambda r: r.select("archive", "offset", "hash").withColumn("node", F.shiftright("offset", LEVELS[0])).join(bad, ["archive", "node"], "left_semi").drop("node")
    both, differ = _differing(inside(records), inside(replica), ["archive", "offset"])
    nodes = compared[0]
    for x in compared[1:]:
        nodes = nodes.unionByName(x)
    return roots.select("archive", F.col("ours").alias("root"), F.col("theirs").alias("replica_root")), both.where(differ), nodes


def report(records: DataFrame, replica: DataFrame) -> DataFrame:
    """One row per archive: n_records, n_bytes, root, replica_root, intact, n_compared (tree nodes looked
    at), n_bad and bad (offset:kind of the records that differ, in order; changed, missing or extra)."""
    roots, bad, nodes = audit(records, replica)
    size = records.groupBy("archive").agg(F.count(F.lit(1)).alias("n_records"), F.sum("size").alias("n_bytes"))
    kind = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
    listed = F.array_sort(F.collect_list(F.struct("offset", kind.alias("kind"))))
    bad = bad.groupBy("archive").agg(F.count(F.lit(1)).alias("n_bad"), F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["offset"].cast("string"), x["kind"])), ",").alias("bad"))
    nodes = nodes.groupBy("archive").agg(F.count(F.lit(1)).alias("n_compared"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return roots.join(size, "archive", "left").join(nodes, "archive", "left").join(bad, "archive", "left").select(
        "archive", zero("n_records"), zero("n_bytes"), "root", "replica_root", F.col("root").eqNullSafe(F.col("replica_root")).alias("intact"),
        zero("n_compared"), zero("n_bad"), F.coalesce("bad", F.lit("")).alias("bad"))
