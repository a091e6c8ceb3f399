"""Tables written to the folder that driver and executors share.

Lineage is cut by writing a table there and reading it again, so that the loss
of an executor never costs more than the step under way.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it gets a scratch folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-stage-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most `rows` rows go to Python at once: a Python worker and the JVM's buffers for it hold a batch whole,
    and a worker keeps the memory of its largest one for the stages that follow."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    spark.conf.set(key, str(rows if now <= 0 else min(now, rows)))


def with_columns(schema: T.StructType, **more: T.DataType) -> T.StructType:
    """The schema and more columns after its own."""
    return T.StructType([*schema.fields, *(T.StructField(k, v) for k, v in more.items())])


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
