"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept,
and returns a frame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkframe.llm import decontam, hyperminhash, linededup, packing, quality
from rinkframe.llm.queries import QUERIES, tokenizer_path
from rinkframe.llm.registry import Query, prepare
from rinkframe.llm.store import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly, go; so do documents left without a line."""
    prepare(spark)
    return linededup.keep_distinct_lines(docs, least_chars=1).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    prepare(spark)
    return hyperminhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]

# Several stages are no SQL; no test compares the rows of run() with a brute-force version yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


ALL = QUERIES | {"pipeline": Query(run, ORACLE_SQL)}
