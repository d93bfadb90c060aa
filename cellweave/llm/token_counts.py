"""Token counts through a digest cache: a table of counts by content digest and tokenizer digest."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, shared_dir, text_of, written

LIMIT = 4096
CACHE = "content binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """The tokenizer's version: the digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _counter(path: str, version: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=path)
            lengths = lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            lengths = lambda texts: [len(x.ids) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                counts = lengths(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([version] * len(counts)), pa.array(counts, pa.int64())], ["content", "tokenizer", "n_tokens"])

    return count


def token_counts(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, a row per document; counts of unknown texts are appended to ``cache``.

    ``cache`` is a Parquet path in a store that all executors reach, with a folder per tokenizer version; it need not exist. The content digest is
    the SHA-256 of the text with null read as empty; the texts themselves aren't altered, for counts must be the
    library's. Misses are made distinct with a map-side combine, so a group of copies of any size is encoded
    once; only digests and counts meet in the last join. Null ids stay null, repeated rows stay repeated, an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("content", F.unhex(F.sha2("text", 256)))
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).select("content", "n_tokens")
    missing = rows.select("content", "text").join(known, "content", "left_anti").groupBy("content").agg(F.first("text").alias("text"))
    missing.mapInArrow(_counter(tokenizer, version), CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).select("content", "n_tokens")
    # Written, because Spark splits the partition of a text that many rows share only in a join of two plain shuffles.
    known = written(known.groupBy("content").agg(F.min("n_tokens").alias("n_tokens")), "known-counts")
    return rows.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")).join(known, "content").select("doc_id", "n_bytes", "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each call starts with an empty cache of its own, so that what it does is the whole work."""
    import public_tokenizers

    cache = f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    counts = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
