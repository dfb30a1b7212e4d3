"""A pipeline over the documents table, from raw texts to token shards.

Each stage takes (spark, docs, sf_dir) and gives a table that is written as Parquet and read
again as the next one's docs. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from treewatt.llm.common import Scratch
from treewatt.llm.decontaminate import decontaminate
from treewatt.llm.mixing import mix_sources
from treewatt.llm.simhash import deduplicate
from treewatt.llm.token_shards import written_and_read
from treewatt.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash, the one with the smallest id."""
    return deduplicate(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target shares."""
    return mix_sources(docs, number_copies=False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written as shards of token ids and read back from them."""
    return written_and_read(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing", mixture),
    ("token output", tokens),
]

ORACLE_SQL = None  # trained scores, SimHash and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
