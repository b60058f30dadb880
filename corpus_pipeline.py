"""A corpus pipeline of five training-data operators: documents in, packed sequences out.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's documents. All but the last return the columns of ``documents``.

Defined cases: null and empty texts fail the quality rules and go; of rows that are repeated one stays
(near-duplicates); rows without a doc_id are kept like others, and come last where an order decides;
further columns of ``documents`` pass through, whatever their names, up to the packing, which drops them;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, line_dedup, packing, quality, simhash
from factloom.llm._shared import drop_path, prepare, scratch_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    prepare(spark)
    return quality.filter_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier elsewhere; those with nothing left go."""
    prepare(spark)
    return line_dedup.stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.stage(docs, table(prepare(spark), sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near-duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: Suffix arrays, winnowing, fingerprints, alignment and tokenisation are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
