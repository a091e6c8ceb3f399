"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet to the cluster's shared folder and read
again. All stages but the last return the columns of `documents`.

1. language ID: documents without a letter, or whose best language has a
   posterior below 0.5, go;
2. line dedup: of near-equal lines one occurrence stays; documents left without
   letters and digits by that go;
3. near-dedup: of documents similar by 0.75 or more on 5-word shingles one stays;
4. decontamination: documents with a benchmark window of 10 words go;
5. packing: the rest in sequences of at most 4096 tokens.

Defined cases (nulls, empty tables and so on) are those of the operators; an
empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontam, langid, lines, packing, registry, setsketch
from ledgerlens.llm.staging import bounded_batches, keep


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return langid.keep_identified(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return setsketch.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"), remove="documents")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack_documents(docs, registry.tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Naive Bayes, SimHash and the tokenizer have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
