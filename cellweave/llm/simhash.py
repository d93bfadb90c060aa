"""SimHash near-duplicate groups, found through an index of deletion-variant signatures.

Two 64-bit fingerprints that differ in at most ``distance`` = 4 bits differ, in at least one of three
segments, by at most one bit: three segments with two or more differences each would make six. So each
distinct fingerprint is indexed under every segment with one bit position left out (a wildcard), 64 rows in
all, and two fingerprints within the distance share at least one of these variants. Fingerprints that share a
variant are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of, unused, written
from cellweave.operators.components import connected_components

BITS = 64
#: Shingles hashed at once; bounds the memory for one text.
_AT_ONCE = 1 << 16
#: Members of an index bucket that one comparison block holds.
BLOCK = 2048


def fingerprint(text: str, words_in_shingle: int = 4) -> int:
    """The unsigned fingerprint of one whole text: bit i is set if over half of the shingles' XXH64 have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, w = xxhash.xxh64_intdigest, words_in_shingle
    n = max(1, len(words) - w + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        hashes = np.fromiter((digest(b" ".join(words[k : k + w]), 42) for k in range(at, min(n, at + _AT_ONCE))), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = np.array([fingerprint(t.as_py()) for t in part.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found), part.column(2)], ["doc_id", "fp", "digest"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``fp`` (the fingerprint as a signed long) and ``digest`` (of the text), a row per document."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("digest"))
    return slim.mapInArrow(_fingerprints, "doc_id long, fp long, digest long")


def segments_for(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one differs by at most one bit within ``distance``."""
    n = distance // 2 + 1
    cuts = [round(k * BITS / n) for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect whatever links within ``distance`` connect among ``fps``, at most len(fps) - 1 of them."""
    out, left = [], np.arange(len(fps))
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            near = np.bitwise_count(fps[reached[:64], None] ^ fps[left][None, :]) <= distance
            hit = near.any(axis=0)
            out += [(int(fps[reached[k]]), int(fps[j])) for k, j in zip(near[:, hit].argmax(axis=0), left[hit], strict=True)]
            reached, left = np.concatenate([reached[64:], left[hit]]), left[~hit]
    return out


def _linker(distance: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket has at most two blocks of members."""

        def pairs(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            change = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            size = np.diff(change)
            a, b = [], []
            small = np.repeat((size > 1) & (size <= 32), size)
            k, f = key[small], fp[small]
            for gap in range(1, int(size[size <= 32].max(initial=1))):
                near = np.flatnonzero((k[gap:] == k[:-gap]) & (np.bitwise_count(f[gap:] ^ f[:-gap]) <= distance))
                a.append(f[near])
                b.append(f[near + gap])
            for at in np.flatnonzero(size > 32):
                if found := _forest(fp[change[at] : change[at + 1]], distance):
                    u, v = np.array(found, np.uint64).T
                    a.append(u)
                    b.append(v)
            u, v = (np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (a, b))
            both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], ["a", "b"])

        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if len(key) < 1 << 16:
                continue
            whole = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
            if whole:
                yield pairs(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield pairs(key, fp)

    return links


def near_links(fps: DataFrame, distance: int = 4, fp_col: str = "fp") -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints, enough to connect all that lie within ``distance``.

    A segment value that many fingerprints share makes large buckets. Its members are dealt into blocks of
    about ``BLOCK`` by hash, and each pair of blocks is a bucket of its own, so that every pair still meets and
    no task holds more than two blocks of a bucket. A large bucket gives a spanning forest of its links, never
    all of its pairs.
    """
    distinct = fps.select(F.col(fp_col).alias("fp")).where(F.col(fp_col).isNotNull()).distinct()
    cuts = segments_for(distance)
    segment = F.array(*[F.struct(F.lit(s).alias("s"), F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1)).alias("part"), F.lit(n).alias("n")) for s, (at, n) in enumerate(cuts)])
    parts = distinct.select("fp", F.explode(segment).alias("x")).select("fp", "x.*")
    hot = parts.groupBy("s", "part", "n").count().where(F.col("count") > BLOCK // 2)
    # A variant leaves one bit open, so its bucket joins two segment values: the larger number of blocks holds for both.
    open_bit = hot.select("s", "part", F.ceil(F.col("count") / (BLOCK // 2)).cast("int").alias("blocks"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bit"))
    both = open_bit.select("s", "bit", "blocks", F.explode(F.array("part", F.expr("part ^ shiftleft(1L, bit)"))).alias("part"))
    large = both.groupBy("s", "part", "bit").agg(F.max("blocks").alias("blocks")).groupBy("s", "part").agg(F.map_from_entries(F.collect_list(F.struct("bit", "blocks"))).alias("large"))
    wild = parts.join(large, ["s", "part"], "left").select("fp", "s", "part", "large", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bit"))
    dealt = wild.withColumn("variant", F.expr("part & ~shiftleft(1L, bit)")).withColumn("blocks", F.coalesce(F.try_element_at("large", F.col("bit")), F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    dealt = dealt.select("fp", "s", "variant", "bit", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    bucket = F.xxhash64("s", "variant", "bit", F.least("own", "other"), F.greatest("own", "other"))
    keyed = dealt.select(bucket.alias("bucket"), "fp")
    found = keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_linker(distance), "a long, b long")
    return found.distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, distance: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp, digest`` of every document, and ``fp, group`` of every distinct fingerprint.

    Groups are named on distinct fingerprints, and written: joins of written tables have no aggregation in their stage, so
    that Spark may split the partition of a fingerprint or group that holds a large part of the rows.
    """
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    parts = connected_components(near_links(fps, distance))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).join(parts, F.col("fp") == F.col("node"), "left")
    return fps, written(distinct.select("fp", "low", F.coalesce("component", "fp").alias("group")), "fingerprint-groups")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4) -> DataFrame:
    """Near-duplicate groups of whole texts: ``doc_id``, ``fp``, ``digest``, ``group`` (the smallest fingerprint that is reachable).

    A null text counts as empty; texts without words have fingerprint zero and link like any other. Repeated
    rows stay repeated, a null id stays null, further columns are ignored, and an empty table gives no rows.
    """
    fps, groups = _grouped(docs, id_col, text_col, distance)
    return fps.join(groups.select("fp", "group"), "fp").select("doc_id", "fp", "digest", "group")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` (the smallest id of the group), a row per document.

    Nulls, empty texts, repeated rows, further columns and empty tables are treated as by ``simhash_groups``.
    """
    fps, groups = _grouped(docs, id_col, text_col, distance)
    least = written(groups.groupBy("group").agg(F.min("low").alias("component_id")), "least-ids")
    named = groups.join(least, "group").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(named, "fp").select("doc_id", hexed, "component_id")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) without near duplicates: of each group the document with the smallest id stays.

    Rows without an id give way to rows with one; rows that repeat both id and text count as one; null texts count
    as empty, and of all documents without words one stays; an empty table gives no rows.
    """
    key, own, digest = unused(docs, "stay_key", "stay_id", "stay_digest")
    groups = simhash_groups(docs, id_col, text_col, distance)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    stay = groups.groupBy("group").agg(F.min(order).alias("x")).select(F.col("x.doc_id").alias(own), F.col("x.digest").alias(digest))
    rows = docs.withColumn(key, F.xxhash64(text_of(text_col)))
    kept = rows.join(stay, (F.col(key) == F.col(digest)) & F.col(id_col).cast("long").eqNullSafe(F.col(own)), "left_semi")
    return kept.dropDuplicates([id_col, key]).drop(key)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
