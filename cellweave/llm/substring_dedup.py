"""Passages that repeat across documents, found by content-defined chunking.

A gear hash rolls over the bytes of each text; a chunk ends where some bits of it are zero, which depends on the
last sixteen bytes alone. So inside a repeated passage the chunks come out alike whatever precedes it, and
insertions shift but do not change them. Chunks are deduplicated by digest; adjacent repeated chunks make a
passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of, written

#: Bits 12 to 15 of the rolling sum depend on at most 16 bytes; one position in 16 ends a chunk.
MASK = np.uint32(0xF000)
MIN_CHUNK, MAX_CHUNK = 16, 1024
#: Of a repeated passage of 50 words at least so many lie in whole chunks; the partial chunks at its ends are lost.
MIN_WORDS = 25
_GEAR = np.random.default_rng(20_240_601).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at once; bounds the memory for one text.
_AT_ONCE = 1 << 22


def _ends(raw: bytes) -> np.ndarray:
    """All positions after which the rolling hash would end a chunk."""
    found = []
    for at in range(0, len(raw), _AT_ONCE):
        back = min(at, 15)
        h = _GEAR[np.frombuffer(raw, np.uint8, min(_AT_ONCE, len(raw) - at) + back, at - back)]
        for step in (1, 2, 4, 8):  # doubles the bytes that a sum covers, up to 16
            h[step:] += h[:-step] << np.uint32(step)
        found.append(np.flatnonzero((h[back:] & MASK) == 0) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text: at the first fitting position ``MIN_CHUNK`` to ``MAX_CHUNK`` bytes on, else at the latter."""
    out, at = [], 0
    for end in _ends(raw).tolist():
        while end - at > MAX_CHUNK:
            at += MAX_CHUNK
            out.append(at)
        if end - at >= MIN_CHUNK:
            out.append(end)
            at = end
    while len(raw) - at > MAX_CHUNK:
        at += MAX_CHUNK
        out.append(at)
    if at < len(raw):
        out.append(len(raw))
    return out


def _chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            ids, starts, sizes, words, digests = [], [], [], [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                raw = text.as_py().encode("utf-8")
                ends = chunk_ends(raw)
                if not ends:
                    continue
                own = np.array([0, *ends])
                spaces = _SPACE[np.frombuffer(raw, np.uint8)]
                begins = spaces.copy()
                begins[1:] = ~spaces[1:] & spaces[:-1]
                begins[0] = not spaces[0]
                ids.append(np.full(len(ends), doc, np.int64))
                starts.append(own[:-1])
                sizes.append(np.diff(own))
                words.append(np.diff(np.r_[0, np.cumsum(begins)][own]))
                digests += [digest(raw[a:b]) for a, b in zip(own[:-1].tolist(), ends, strict=True)]
            if digests:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(words).astype(np.int32)), pa.array(np.array(digests, np.uint64).view(np.int64))], ["doc_id", "start", "size", "words", "digest"])


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, size, words, digest``: the chunks of every whole text, in bytes of UTF-8."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).where("doc_id is not null")
    return slim.mapInArrow(_chunker, "doc_id long, start long, size int, words int, digest long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, start, end, n_words, first_doc_id, is_first``: a row per passage that occurs in another document too.

    ``start`` and ``end`` are byte offsets. ``first_doc_id`` is the least id of a document that holds the passage's
    first chunk; ``is_first`` marks passages of which the document itself holds every chunk first. Rows that repeat
    an id count as one document, and what repeats inside one document alone is not reported. Rows with a null id
    take no part; null and empty texts have no chunks; an empty table gives no rows.
    """
    cut = written(chunks(docs, id_col, text_col), "chunks")
    repeated = cut.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    # Written, because Spark splits the partition of a digest that many rows share only in a join of two plain shuffles.
    repeated = written(repeated, "repeated-digests")
    shared = cut.join(repeated, "digest").select("doc_id", "start", (F.col("start") + F.col("size")).alias("end"), "words", "first").distinct()
    in_order = W.partitionBy("doc_id").orderBy("start", "end")
    breaks = shared.withColumn("break", F.coalesce((F.lag("end").over(in_order) < F.col("start")).cast("int"), F.lit(1)))
    runs = breaks.withColumn("run", F.sum("break").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    found = runs.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min_by("first", "start").alias("first_doc_id"), F.min((F.col("first") == F.col("doc_id"))).alias("is_first"))
    return found.where(F.col("n_words") >= min_words).drop("run")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))
