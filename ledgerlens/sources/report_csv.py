"""Reports as CSV (S6): bounded files in the report's order, and lines as a relation.

A sorted report is range-partitioned, so its files follow each other as their
partitions do. The folder `_manifest` beside them (which Spark's readers skip)
lists the files in order with their rows, so that the order survives renaming
services and listings; `read_report_csv` returns the rows in that order.
Fields with commas, quotes or line breaks are quoted, quotes are doubled, and
spaces at a field's ends stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one file.
MAX_RECORDS = 1_000_000
OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_MANIFEST = "position int, file string, n_rows bigint"


def plain_numbers(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles as decimals of `digits` places, so that no amount is written with an exponent."""
    return df.select(*[F.col(f.name).cast(f"decimal(38,{digits})").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema])


def csv_lines(df: DataFrame, **options: str) -> DataFrame:
    """S6 as a relation: one column `line` with the CSV text of each row."""
    return df.select(F.to_csv(F.struct("*"), options).alias("line"))


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite", max_records: int = MAX_RECORDS) -> None:
    """Rows for people, with a header in every file and at most `max_records` rows in each. Column names must be unique."""
    cols = df.columns
    dupes = {c for c in cols if cols.count(c) > 1}
    if dupes:
        raise ValueError(f"duplicate output columns {sorted(dupes)}")
    df.write.mode(mode).options(**OPTIONS, header="true", maxRecordsPerFile=str(max_records)).csv(path)
    # part-<partition>-<job>-c<file of the partition>.csv
    rows = _files(df.sparkSession.read.schema(df.schema), path).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("bigint")
    position = F.row_number().over(Window.orderBy(number(r"^part-(\d+)"), number(r"c(\d+)\.csv"), "file"))  # one row per file
    rows.select(position.alias("position"), "file", "n_rows").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/_manifest")


def _files(reader, path: str) -> DataFrame:
    """Rows of all files with the name of their file. A field may hold line breaks, so a file is read whole."""
    return reader.options(**OPTIONS, header="true", multiLine="true").csv(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a written report, sorted as they were written."""
    manifest = spark.read.schema(_MANIFEST).option("header", True).csv(f"{path}/_manifest")
    rows = _files(spark.read.schema(schema), path).withColumn("_row", F.monotonically_increasing_id())
    return rows.join(manifest, "file").orderBy("position", "_row").select(*schema.names)
