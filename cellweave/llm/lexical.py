"""Ranked lexical search: variable-block-max WAND, exact, in integers.

A forward index holds each document's terms. Shards are runs of documents small enough for a task's memory; a shard's
posting lists are cut into blocks of varying length by dynamic programming, so that the blocks' maxima bound the scores as
tightly as their number allows. A search goes through a shard in the order of document ids, from pivot to pivot, and
skips every run of documents whose block maxima can't reach the worst score among the best so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.llm.common import bounded, read_table, text_of, written

#: Results for each item.
TOP = 20
#: Postings of the searched terms that a shard holds at most (or those of one document, if more).
SHARD_POSTINGS = 1 << 19
#: Rows of the items' terms that one pass broadcasts, and rows of a vocabulary that a join broadcasts.
PASS_TERMS, FEW_TERMS = 200_000, 500_000
#: Postings that stay together when blocks are chosen, the most such units in a block, and what a block must save in bound
#: error, in contributions of a term that one document in e holds.
UNIT, MOST_UNITS, BLOCK_COST = 8, 64, 8_000_000_000

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """The maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(_TABLE).split()


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            counts = [Counter(terms_of(t)) for t in part.column(1).to_pylist()]
            offsets = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
            terms = pa.ListArray.from_arrays(offsets, pa.array([t for c in counts for t in c], pa.binary()))
            tf = pa.ListArray.from_arrays(offsets, pa.array([n for c in counts for n in c.values()], pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.total() for c in counts], pa.int64()), terms, tf], ["doc_id", "n", "terms", "tf"])


def forward_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), ``terms`` and ``tf`` of every row, without a shuffle. Null and empty texts have no terms."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(_forward, "doc_id long, n long, terms array<binary>, tf array<int>")


# ---- blocks ----


def cut_blocks(starts: np.ndarray, score: np.ndarray, unit: int = UNIT, most: int = MOST_UNITS, cost: int = BLOCK_COST) -> np.ndarray:
    """Where blocks end (positions behind their last postings), for all lists ``score[starts[t]:starts[t + 1]]`` at once.

    Of all ways to cut a list at multiples of ``unit`` postings into blocks of ``most`` units at most, the one with the least sum of bound error
    (over a block's postings, its maximum less the score) and ``cost`` for each block: best[i] = min over k of best[i - k] + error + cost.
    """
    sizes = np.diff(starts)
    units = -(-sizes // unit)
    first = np.concatenate([[0], np.cumsum(units)])
    if not first[-1]:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), units)
    begin = starts[owner] + (np.arange(first[-1]) - first[owner]) * unit
    end = np.minimum(begin + unit, starts[owner + 1])
    top, total = np.maximum.reduceat(score, begin), np.add.reduceat(score, begin)
    # best and the running sums have one more place than a list has units
    place = first[:-1] + np.arange(len(sizes))
    best = np.zeros(first[-1] + len(sizes), np.int64)
    back = np.zeros(len(best), np.int64)
    by_length = np.argsort(-units, kind="stable")
    lengths = -units[by_length]
    for i in range(1, int(units.max()) + 1):
        lists = by_length[: np.searchsorted(lengths, -i, side="right")]
        k = np.arange(min(i, most))
        at = first[lists][:, None] + i - 1 - k
        peak = np.maximum.accumulate(top[at], axis=1)
        error = peak * (end[at[:, 0]][:, None] - begin[at]) - np.cumsum(total[at], axis=1)
        sums = best[place[lists][:, None] + i - 1 - k] + error + cost
        pick = np.argmin(sums, axis=1)
        best[place[lists] + i] = sums[np.arange(len(lists)), pick]
        back[place[lists] + i] = pick + 1
    ends, lists, i = [], np.flatnonzero(units), units[units > 0]
    while len(lists):
        ends.append(end[first[lists] + i - 1])
        i = i - back[place[lists] + i]
        lists, i = lists[i > 0], i[i > 0]
    return np.sort(np.concatenate(ends))


class Shard:
    """Posting lists of the searched terms over documents in the order of their ids, and the blocks' bounds."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]], weights: np.ndarray, n_docs: int, n_terms: int):
        ids, known, lengths, counts, terms, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, ~known))
        self.ids, self.known = ids[order], known[order]
        ordinal = np.empty(len(ids), np.int64)
        ordinal[order] = np.arange(len(ids))
        doc = np.repeat(ordinal, counts)
        m = np.repeat(75 + (25 * lengths * n_docs) // max(n_terms, 1), counts)
        self.stride = len(ids) + 1
        key = terms * self.stride + doc
        order = np.argsort(key)
        self.key, tf, m = key[order], tf[order].astype(np.int64), m[order]
        self.doc = self.key % self.stride
        self.score = weights[self.key // self.stride] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        self.starts = np.searchsorted(self.key, np.arange(len(weights) + 1) * self.stride)
        ends = cut_blocks(self.starts, self.score)
        begins = np.concatenate([[0], ends[:-1]])
        self.block_key, self.block_doc = self.key[ends - 1], self.doc[ends - 1]
        self.block_max = np.maximum.reduceat(self.score, begins) if len(ends) else np.zeros(0, np.int64)
        self.block_stop = np.searchsorted(self.block_key, np.arange(1, len(weights) + 1) * self.stride)
        full = np.flatnonzero(np.diff(self.starts))
        self.list_max = np.zeros(len(weights), np.int64)
        self.list_max[full] = np.maximum.reduceat(self.score, self.starts[full]) if len(full) else 0

    def least(self, terms: np.ndarray, counts: np.ndarray, k: int) -> int:
        """A score that ``k`` documents reach for sure: the k-th largest contribution of one term."""
        out = 1
        for t, c in zip(terms, counts, strict=True):
            own = self.score[self.starts[t] : self.starts[t + 1]]
            if len(own) >= k and self.list_max[t] * c > out:
                out = max(out, int(np.partition(own, len(own) - k)[len(own) - k]) * int(c))
        return out

    def search(self, terms: np.ndarray, counts: np.ndarray, best: Best) -> None:
        """Offers ``best`` every document that can belong to it."""
        there = self.starts[terms] < self.starts[terms + 1]
        terms, counts = terms[there], counts[there]
        if not len(terms):
            return
        base, stop, block_stop = terms * self.stride, self.starts[terms + 1], self.block_stop[terms]
        most, far = self.list_max[terms] * counts, self.stride - 1
        doc, block_doc, block_max, last, last_block = self.doc, self.block_doc, self.block_max, len(self.doc) - 1, len(self.block_doc) - 1
        at = self.starts[terms].copy()
        best.reach(self.least(terms, counts, best.k))
        while True:
            here = np.where(at < stop, doc[np.minimum(at, last)], far)
            order = np.argsort(here)
            pivot_at = np.searchsorted(np.cumsum(most[order]), best.least)
            if pivot_at == len(order) or (pivot := here[order[pivot_at]]) == far:
                return
            inside = here <= pivot
            block = np.searchsorted(self.block_key, base + pivot)
            live = inside & (block < block_stop)
            block = np.minimum(block, last_block)
            end = min(here[~inside].min(initial=far), block_doc[block[live]].min(initial=far - 1) + 1)
            bound = (block_max[block] * counts)[live].sum()
            if bound >= best.least:
                first, behind = np.searchsorted(self.key, base[live] + pivot), np.searchsorted(self.key, base[live] + end)
                many = behind - first
                places = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
                sums = np.zeros(end - pivot, np.int64)
                np.add.at(sums, doc[places] - pivot, self.score[places] * np.repeat(counts[live], many))
                good = np.flatnonzero(sums >= best.least)
                if len(good):
                    best.offer(sums[good], self.known[good + pivot], self.ids[good + pivot])
            at[inside] = np.searchsorted(self.key, base[inside] + end)


class Best:
    """The ``k`` best documents of one item: highest scores, equal ones by ascending ids, unknown ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.known, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def reach(self, score: int) -> None:
        self.least = max(self.least, score)

    def offer(self, score: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        score, known, ids = np.concatenate([self.score, score]), np.concatenate([self.known, known]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~known, -score))[: self.k]
        self.score, self.known, self.ids = score[order], known[order], ids[order]
        if len(order) == self.k:
            self.reach(int(self.score[-1]))


def _shards(batches: Iterator[pa.RecordBatch], vocabulary: pa.Array, most: int) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """The postings of the vocabulary's terms, in lists of parts that hold ``most`` postings at most."""
    parts, held = [], 0
    for batch in batches:
        at = 0
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(ends, before + most // 4, side="right")))
            part = batch.slice(at, until - at)
            at = until
            found = pc.index_in(part.column("terms").flatten(), value_set=vocabulary)
            mine = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
            owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("terms")).to_numpy())
            ids = part.column("doc_id")
            if parts and held + len(mine) > most:
                yield parts
                parts, held = [], 0
            held += len(mine)
            parts.append((
                pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy(zero_copy_only=False), part.column("n").to_numpy(), np.bincount(owner[mine], minlength=part.num_rows),
                found.take(pa.array(mine)).to_numpy().astype(np.int64), part.column("tf").flatten().to_numpy()[mine],
            ))
    if parts:
        yield parts


def _searcher(sent, n_docs: int, n_terms: int, k: int, most: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, items = sent.value
        best = {item: Best(k) for item in items}
        for parts in _shards(batches, pa.array(vocabulary, pa.binary()), most):
            shard = Shard(parts, weights, n_docs, n_terms)
            for item, (terms, counts) in items.items():
                shard.search(terms, counts, best[item])
        for item, b in best.items():
            if len(b.score):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(b.score), pa.int64()), pa.array(b.ids, pa.int64(), mask=~b.known), pa.array(b.score, pa.int64())], ["item_id", "doc_id", "score"])

    return search


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shard_postings: int = SHARD_POSTINGS, pass_terms: int = PASS_TERMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``k`` best documents with a score above 0.

    Every row of ``docs`` is a document: repeated rows rank each for themselves, null ids stay null and come last among
    equal scores, and null or empty texts have no terms and count for nothing. Rows of ``items`` with the same id, null
    included, are one item with the terms of all. Items without a term in any document and empty tables give no rows. Further columns are ignored.

    The forward index is written once, and neither documents nor postings are shuffled: each task builds the shards of
    what it reads and keeps an item's best over all of them. Items are searched in passes whose terms, ``pass_terms`` rows
    of them, are broadcast. A hot term costs a longer list in each shard; a group of copies is spread as its rows are.
    """
    spark = docs.sparkSession
    forward = written(forward_index(docs, id_col, text_col), "forward-index", compression="zstd")
    sums = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum(F.col("n").cast("decimal(38,0)")).alias("terms")).first()
    n_docs, n_terms = sums["docs"], int(sums["terms"] or 0)
    asked = forward_index(items, item_col, item_text).select(F.col("doc_id").alias("item_id"), F.explode(F.arrays_zip("terms", "tf")).alias("x")).select("item_id", F.col("x.terms").alias("term"), F.col("x.tf").alias("c"))
    asked = written(asked.groupBy("item_id", "term").agg(F.sum("c").alias("c")), "item-terms")
    vocabulary = written(asked.select("term").distinct(), "vocabulary")
    df = written(forward.select(F.explode("terms").alias("term")).join(bounded(vocabulary, FEW_TERMS), "term").groupBy("term").agg(F.count("*").alias("df")), "document-counts")
    asked = written(asked.join(bounded(df, FEW_TERMS), "term"), "item-weights")
    passes = max(1, -(-asked.count() // pass_terms))
    found = None
    for p in range(passes):
        numbers: dict[bytes, int] = {}
        weights, own = [], {}
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect():
            term = bytes(r["term"])
            if term not in numbers:
                numbers[term] = len(weights)
                weights.append(weight(n_docs, r["df"]))
            own.setdefault(r["item_id"], []).append((numbers[term], r["c"]))
        plans = {item: tuple(np.array(x, np.int64) for x in zip(*sorted(rows), strict=True)) for item, rows in own.items()}
        sent = spark.sparkContext.broadcast((list(numbers), np.array(weights, np.int64), plans))
        part = forward.mapInArrow(_searcher(sent, n_docs, n_terms, k, shard_postings), "item_id long, doc_id long, score long")
        found = part if found is None else found.union(part)
    best = W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_sql() -> str:
    terms = "unnest(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    return f"""WITH words AS (SELECT doc_id, {terms.format("text")} AS term FROM documents),
            tfs AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
            docs AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
            total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
            dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
            asked AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, {terms.format("text")} AS term FROM benchmark) GROUP BY ALL),
            weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM dfs, total),
            scored AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
                FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN docs USING (doc_id), total GROUP BY item_id, doc_id)
        SELECT item_id, rank, doc_id, score FROM (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM scored WHERE score > 0) WHERE rank <= 20"""
