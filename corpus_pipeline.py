"""A corpus pipeline of five operators: ``run(spark, sf_dir)`` applies them to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last keep
the columns of ``documents`` and take rows away; the last gives the pieces of
the packed training windows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, importance, jaccard_join, packing, toxicity
from tessella.llm.common import materialise, small_batches, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    small_batches(spark)
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance sample go."""
    small_batches(spark)
    return importance.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates stays, whatever its doc_id."""
    small_batches(spark)
    return jaccard_join.one_row_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    small_batches(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest in windows of 4096 tokens."""
    small_batches(spark)
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), ids=F.crc32("ids"))
    return pieces.select("doc_id", "start", "length", F.col("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxic),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: Trained scores, Gumbel noise and a tokenizer are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
