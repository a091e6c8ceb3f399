"""Named-table scan.

`Tables` resolves a table name to a DataFrame: driver tables are read from
Parquet (column pruning and filter pushdown happen at the scan), payments
tables are the fixture views bound on top of them. DataFrames are lazy, so
a report only scans what its plan needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import DRIVER_TABLES, FIXTURES, deps

_CACHE: dict[tuple[int, str], "Tables"] = {}


# Sort key written inside each materialised fact table, so Parquet row-group
# min/max statistics let range filters on it skip data.
SORT_KEYS = {
    "balance_transactions": "created", "connected_account_balance_transactions": "created",
    "charges": "created", "refunds": "created", "disputes": "created",
    "icplus_fees": "incurred_at", "transfers": "created", "connected_account_transfers": "created",
    "application_fees": "created", "application_fee_refunds": "created",
    "connected_account_charges": "created",
}


class Tables:
    """Tables by name. `bind` names the user's own: a DataFrame, a catalog table
    ("db.charges"), or (path, schema) of Parquet files, the schema a StructType
    or DDL. Bound tables come first; others are the driver's or derived ones."""

    def __init__(self, spark: SparkSession, sf_dir: str = "", derived_dir: str | None = None,
                 bind: dict[str, DataFrame | str | tuple] | None = None):
        self.spark = spark
        self.bind = bind or {}
        self.sf_dir = sf_dir.rstrip("/")
        self.derived_dir = derived_dir.rstrip("/") if derived_dir else None
        self._dfs: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        df = self._dfs.get(name)
        if df is None:
            if name in self.bind:
                df = self._bound(self.bind[name])
            elif name in DRIVER_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif self.derived_dir and name in FIXTURES and not name.startswith("order_facts"):
                df = self.spark.read.parquet(f"{self.derived_dir}/{name}")
            elif name in FIXTURES:
                df = self.spark.sql(FIXTURES[name], **{d: self[d] for d in deps(name)})
            else:
                raise KeyError(f"unknown table {name!r}")
            self._dfs[name] = df
        return df

    def _bound(self, source) -> DataFrame:
        if isinstance(source, DataFrame):
            return source
        if isinstance(source, tuple):
            path, schema = source
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.table(source)


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, names=None, bind=None) -> Tables:
    """Write the derived payments tables once as Parquet; return Tables reading them.

    Fact tables are range-partitioned and sorted on their event time so that
    date filters skip row groups; each table is written by a distributed job
    (no driver collect), and re-running overwrites.
    """
    src = Tables(spark, sf_dir, bind=bind)
    for name in names or [n for n in FIXTURES if n != "order_facts"]:
        df = src[name]
        key = SORT_KEYS.get(name)
        if key:
            df = df.repartitionByRange(key).sortWithinPartitions(key)
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
    return Tables(spark, sf_dir, derived_dir=out_dir, bind=bind)


def bucketed(tables: Tables, database: str, keys: dict[str, str], buckets: int) -> dict[str, str]:
    """Write tables as catalog tables in `buckets` buckets of their join key, sorted by it; return them for `bind`.

    A join on that key then reads them as they lie, so only its other side is
    shuffled. Take at least as many buckets as the session has shuffle
    partitions.
    """
    for name, key in keys.items():
        tables[name].repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
    return {name: f"{database}.{name}" for name in keys}


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (id(spark), sf_dir.rstrip("/"))
    t = _CACHE.get(key)
    if t is None or t.spark is not spark:
        t = Tables(spark, sf_dir)
        _CACHE[key] = t
    return t


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once (a distributed check; empty when unique).

    Used to back the plans that rely on key uniqueness, e.g. dropping left
    joins whose right side is never selected (J9) or looking a payout up
    after reducing the ledger to distinct payout ids.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
