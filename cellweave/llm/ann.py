"""Nearest neighbours by inner product: a forest of random-projection trees, one priority queue over all its trees,
and exact scores for what the visited leaves hold.

The split planes are fitted on a bounded sample; every vector is then routed to one leaf of each tree. Vectors
get one more coordinate that makes all lengths equal, so that the largest inner product is the smallest angle.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, written

#: The trees, and about how many vectors a leaf holds at least: the trees' depth follows from the number of distinct vectors.
TREES, LEAF = 12, 100
#: The share of neighbours that the visits are to find, and how many vectors of the sample, with how many neighbours each, it is measured on.
RECALL, MEASURED, NEIGHBOURS = 0.94, 64, 20
#: Tables of fewer distinct vectors have one leaf only.
ONE_LEAF = 2 * LEAF
#: Vectors the planes are fitted on: so many for each leaf, those with the least hashes; and the most of them at all.
SAMPLE_PER_LEAF, SAMPLE_ROWS = 32, 1 << 17
#: Distinct vectors or queries that meet in one task at a time.
BLOCK = 8192


@dataclass
class Forest:
    planes: np.ndarray  # tree x inner node x (dimension + 1)
    offsets: np.ndarray  # tree x inner node
    radius: float

    @property
    def depth(self) -> int:
        return (self.planes.shape[1] + 1).bit_length() - 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that brings their length to ``radius``."""
        rest = np.sqrt(np.maximum(self.radius**2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """vector x tree: the leaf that each vector falls into."""
        lifted = self.lifted(x)
        out = np.empty((len(x), len(self.planes)), np.int64)
        for t, (planes, offsets) in enumerate(zip(self.planes, self.offsets, strict=True)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = (lifted * planes[node]).sum(axis=1) > offsets[node]
                node = 2 * node + 1 + right
            out[:, t] = node - len(planes)
        return out

    def visits(self, q: np.ndarray, n: int) -> list[tuple[int, int]]:
        """The ``n`` most promising (tree, leaf) for a query, of all trees: the queue is ordered by the squared distances to the planes passed on their wrong sides."""
        inner = self.planes.shape[1]
        margin = self.planes[:, :, :-1] @ q - self.offsets
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        out = []
        while queue and len(out) < n:
            cost, t, node = heapq.heappop(queue)
            if node >= inner:
                out.append((t, node - inner))
                continue
            m = float(margin[t, node])
            heapq.heappush(queue, (cost + max(m, 0.0) ** 2, t, 2 * node + 1))
            heapq.heappush(queue, (cost + min(m, 0.0) ** 2, t, 2 * node + 2))
        return out


def depth_for(vectors: int) -> int:
    """Levels of planes for so many distinct vectors; the sample's bound is that of the leaves, too.

    Leaves and what each holds grow alike, with the square root of the table. With leaves of one size the visits of a query would grow nearly
    with the table, as vectors that fill all their dimensions need a share of it, and each visit is a row with the vector and ``top`` found.
    """
    if vectors < ONE_LEAF:
        return 0
    return min(round(math.log2(vectors / max(LEAF, math.sqrt(vectors)))), int(math.log2(SAMPLE_ROWS / SAMPLE_PER_LEAF)))


def fit_forest(sample: np.ndarray, radius: float, trees: int, depth: int, seed: int = 7) -> Forest:
    """Each plane separates two random points of its cell, drawn to the means of their sides, at the median."""
    rng = np.random.default_rng(seed)
    forest = Forest(np.zeros((trees if depth else 1, (1 << depth) - 1, sample.shape[1] + 1)), np.zeros((trees if depth else 1, (1 << depth) - 1)), radius)
    x = forest.lifted(sample)
    for t in range(len(forest.planes)):
        cells = {0: np.arange(len(x))}
        for node in range((1 << depth) - 1):
            index = cells.pop(node)
            own = x[index]
            a, b = own[rng.choice(len(own), 2, replace=len(own) < 2)] if len(own) else rng.normal(size=(2, x.shape[1]))
            for _ in range(4):
                near = ((own - a) ** 2).sum(axis=1) < ((own - b) ** 2).sum(axis=1)
                if near.all() or not near.any():
                    break
                a, b = own[near].mean(axis=0), own[~near].mean(axis=0)
            plane = a - b if np.any(a != b) else rng.normal(size=x.shape[1])
            plane = plane / np.linalg.norm(plane)
            at = own @ plane
            forest.planes[t, node], forest.offsets[t, node] = plane, np.median(at) if len(own) else 0.0
            right = at > forest.offsets[t, node]
            cells[2 * node + 1], cells[2 * node + 2] = index[~right], index[right]
    return forest


def visits_needed(forest: Forest, sample: np.ndarray, recall: float = RECALL) -> int:
    """Leaves to visit so that among the vectors of the sample ``recall`` of the nearest are met, measured on a few of them.

    In the whole table the nearest are nearer than in its sample, so that it takes no more visits there.
    """
    leaves, inner = forest.leaves(sample), forest.planes.shape[1]
    every = len(forest.planes) * (inner + 1)
    first = []
    for q in np.unique(np.linspace(0, len(sample) - 1, MEASURED).astype(int)):
        score = sample @ sample[q]
        score[q] = -np.inf
        near = np.argsort(-score)[: min(NEIGHBOURS, len(sample) - 1)]
        order = np.full((len(forest.planes), inner + 1), every)
        for k, (t, leaf) in enumerate(forest.visits(sample[q], every)):
            order[t, leaf] = k
        first.append(order[np.arange(len(forest.planes)), leaves[near]].min(axis=1))
    first = np.sort(np.concatenate(first))
    return int(first[min(len(first) - 1, math.ceil(recall * len(first)))]) + 1 if len(first) else 1


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _kind(rows: DataFrame, vector_col: str) -> str:
    """Vectors of floats stay so; all others are doubles."""
    return "float" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "double"


def _components(rows: DataFrame, vector_col: str):
    kind = _kind(rows, vector_col)
    return F.transform(vector_col, lambda x: x.cast(kind))


def distinct_vectors(rows: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """``vid, vec, ids``: a row per distinct usable vector, with its ``keep`` smallest ids; ``vid`` is the smallest.

    Spark limits the ranked groups before the shuffle, so a vector of any number of rows costs ``keep`` rows a task.
    Vectors of another dimension than the most frequent one take no part.
    """
    vec = _components(rows, vector_col)
    usable = rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    usable = usable.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    size = usable.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    usable = usable.where(F.size("vec") == (size["n"] if size else 0))
    nth = F.row_number().over(W.partitionBy("vec").orderBy("id"))
    least = usable.withColumn("nth", nth).where(F.col("nth") <= keep)
    return least.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("vid"), "vec", "ids")


def _router(shared):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.leaves(_matrix(batch.column(1)))
            for t in range(leaves.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaves), t, np.int32)), pa.array(leaves[:, t].astype(np.int32)), batch.column(0), batch.column(1)], ["tree", "leaf", "vid", "vec"])

    return route


def _visitor(shared, visits: int):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.visits(q, visits) for q in _matrix(batch.column(1))]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            tree, leaf = np.array([p for x in found for p in x], np.int32).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(tree)), pa.array(np.ascontiguousarray(leaf)), batch.column(0).take(owner), batch.column(1).take(owner)], ["tree", "leaf", "vid", "vec"])

    return visit


def _rerank(top: int):
    def rerank(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "near": []}
        if len(queries) and len(vectors):
            x, vid = np.stack(vectors["vec"].to_numpy()).astype(np.float64), vectors["vid"].to_numpy()
            q, qid = np.stack(queries["vec"].to_numpy()).astype(np.float64), queries["vid"].to_numpy()
            for at in range(0, len(q), 512):
                scores = q[at : at + 512] @ x.T
                for k, row in enumerate(scores):
                    if len(row) > top:  # all that tie with the last place take part in the order
                        held = np.flatnonzero(row >= np.partition(row, -top)[-top])
                    else:
                        held = np.arange(len(row))
                    held = held[np.lexsort((vid[held], -row[held]))][:top]
                    out["qid"].append(qid[at + k])
                    out["near"].append([{"away": -float(row[j]), "vid": int(vid[j])} for j in held])
        return pd.DataFrame(out)

    return rerank


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 20, trees: int = TREES, visits: int | None = None, depth: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows found for each row of ``queries`` (ids of ``rows``), but itself.

    The nearest by inner product come first, ties by the smaller id; scores are in double precision on the components as
    they are. Vectors that are null, zero or hold null or non-finite components take no part, on either side. Equal
    vectors are searched once and expanded from their smallest ids, so a vector that many rows share costs no more.
    Leaves are compared in blocks of bounded size. Unless given, the number of ``visits`` is what
    finds ``RECALL`` of the neighbours within the sample that the planes are fitted on. An empty table gives no rows.
    """
    spark, kind = rows.sparkSession, _kind(rows, vector_col)
    vectors = written(distinct_vectors(rows, id_col, vector_col, top + 1), "vectors")
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.transform(vector_col, lambda x: x.cast(kind)).alias("vec")).where("query_id is not null").dropDuplicates(["query_id"])
    asked = written(asked.join(vectors.select("vid", "vec"), "vec").select("query_id", "vid"), "queries")
    known = vectors.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("r"), F.count("*").alias("n")).first()
    if not known["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    depth = depth_for(known["n"]) if depth is None else depth
    sample = vectors.select("vec").orderBy(F.xxhash64("vid"), "vid").limit(min(SAMPLE_ROWS, SAMPLE_PER_LEAF << depth)).toArrow().column(0).combine_chunks()
    forest = fit_forest(_matrix(sample), float(np.sqrt(known["r"])), trees if depth else 1, depth)
    visits = visits_needed(forest, _matrix(sample)) if visits is None else visits
    shared = spark.sparkContext.broadcast(forest)
    row = f"tree int, leaf int, vid long, vec array<{kind}>"
    routed = vectors.select("vid", "vec").mapInArrow(_router(shared), row)
    # The queue's work is done once; both uses below read it.
    sought = written(asked.select("vid").distinct().join(vectors.select("vid", "vec"), "vid").mapInArrow(_visitor(shared, visits), row), "visits")
    # How many blocks a leaf takes on either side; a row per leaf of the forest, whatever the input's size.
    blocks = lambda side, name: side.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    sizes = F.broadcast(written(blocks(routed, "v_blocks").join(blocks(sought, "q_blocks"), ["tree", "leaf"]), "leaves"))
    own = lambda n: F.pmod(F.xxhash64("vid"), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sought.join(sizes, ["tree", "leaf"]).select("tree", "leaf", own("q_blocks").alias("qb"), every("v_blocks").alias("vb"), "vid", "vec")
    right = routed.join(sizes, ["tree", "leaf"]).select("tree", "leaf", every("q_blocks").alias("qb"), own("v_blocks").alias("vb"), "vid", "vec")
    keys = ["tree", "leaf", "qb", "vb"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_rerank(top + 1), "qid long, near array<struct<away: double, vid: long>>")
    # A query's lists are as many as its visits and blocks; places are taken over the distinct vectors found.
    best = met.select("qid", F.explode("near").alias("x")).select("qid", "x.vid", "x.away").groupBy("qid", "vid").agg(F.min("away").alias("away"))
    place = F.row_number().over(W.partitionBy("qid").orderBy("away", "vid"))
    best = best.withColumn("place", place).where(F.col("place") <= top + 1)
    rows_found = best.join(vectors.select("vid", F.col("ids")), "vid").select("qid", "away", F.explode("ids").alias("id"))
    lists = rows_found.groupBy("qid").agg(F.slice(F.array_sort(F.collect_list(F.struct("away", "id"))), 1, top + 1).alias("near"))
    found = asked.join(lists, asked["vid"] == lists["qid"]).select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, top).alias("near"))
    return found.select("query_id", F.posexplode("near").alias("pos", "x")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.away")).alias("score"))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0))
