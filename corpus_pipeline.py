"""The corpus pipeline: each stage's function takes (spark, docs, sf_dir) and gives what goes on to the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, shared_dir, unused
from cellweave.llm.decontaminate import without_contaminated
from cellweave.llm.line_dedup import dedup_lines
from cellweave.llm.packing import packed_documents
from cellweave.llm.simhash import keep_one_of_each_group
from cellweave.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document of which nothing but white space is left goes with them. ``n_chars`` follows the text."""
    n_lines, n_gone = unused(docs, "n_lines", "n_gone")
    rest = dedup_lines(docs, min_words=1, counts=(n_lines, n_gone)).where((F.col(n_gone) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    return rest.withColumn("n_chars", F.when(F.col(n_gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    import public_tokenizers

    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the learned score, the fingerprints nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written as Parquet in the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
