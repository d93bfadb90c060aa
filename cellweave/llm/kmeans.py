"""Centroid clustering by partial-distance search, in integers throughout.

A vector's squared distance to a centroid is added up over a few dimensions at a time, those of high variance first, and
given up once it is strictly above the best known; what survives all dimensions is exact, so the order of the
dimensions changes the work and never a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, written

#: Dimensions whose squared differences are added before the next look at which vectors are still in the race.
STEP = 8
#: Largest component after scaling: squared distances of 64 such components fit a long.
LARGEST = 1 << 27


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the nearest centroid (of equal ones the smaller number) and the squared distance, exactly.

    The first ``step`` dimensions pick a first guess; every other centroid then has to stay at or below the best distance so far.
    """
    x, centroids = x[:, order], centroids[:, order]
    rows, dims = x.shape
    first = [((x[:, :step] - c[:step]) ** 2).sum(axis=1) for c in centroids]
    which = np.argmin(first, axis=0)
    best = ((x - centroids[which]) ** 2).sum(axis=1)
    for number, c in enumerate(centroids):
        alive = np.flatnonzero((which != number) & (first[number] <= best))
        part = first[number][alive]
        for at in range(step, dims, step):
            if not alive.size:
                break
            part = part + ((x[alive, at : at + step] - c[at : at + step]) ** 2).sum(axis=1)
            stays = part <= best[alive]
            alive, part = alive[stays], part[stays]
        wins = (part < best[alive]) | (number < which[alive])
        best[alive[wins]], which[alive[wins]] = part[wins], number
    return which, best


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _sums(centroids: np.ndarray, order: np.ndarray):
    """For mapInArrow: a task's count and componentwise sums of each centroid's vectors, a row per centroid that has any."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch, centroids.shape[1])
            which, _ = nearest(x, centroids, order)
            np.add.at(total, which, x)
            count += np.bincount(which, minlength=len(centroids))
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(has, pa.int32()), "n": pa.array(count[has], pa.int64()), "total": pa.array(list(total[has]), pa.list_(pa.int64()))})

    return add


def _assign(centroids: np.ndarray, order: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, best = nearest(_matrix(batch, centroids.shape[1]), centroids, order)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(which, pa.int32()), pa.array(best, pa.int64())], ["vec_id", "cluster", "distance"])

    return assign


def scaled(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``x`` (floor of scale times each component) of the vectors that take part."""
    x = F.col(vec_col).cast("array<double>")
    fits = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(F.floor(F.when(F.abs(v) < LARGEST, v).otherwise(F.lit(None)) * scale)) <= LARGEST), F.lit(False)))
    return vectors.where((F.size(x) == dims) & fits).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the least hashes of seed and id; a bounded top-k, never a sort of the table."""
    tag = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(tag.asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def by_variance(kept: DataFrame, dims: int) -> np.ndarray:
    """The dimensions, the most spread first; one row of sums comes to the driver."""
    sums = kept.agg(*[F.var_pop(F.col("x")[d].cast("double")).alias(f"v{d}") for d in range(dims)]).first()
    return np.argsort([-(v or 0.0) for v in sums], kind="stable")


def kmeans(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The assignment (``vec_id``, ``cluster``, ``distance``) to the final centroids, and the centroids.

    Vectors that are null, have not exactly ``dims`` components or hold a null or non-finite one take no part, nor do those with a
    scaled component beyond 2^27 (their distances would not fit a long). The centroids start as the ``k`` vectors with the least
    SHA-256 of ``seed:id`` (all, if there are fewer; null ids come last, equal ids by their components); each round
    replaces every centroid that has vectors by the exact floor of their mean. Ties go to the smaller number. Repeated
    rows count each time; an empty table gives no rows and no centroids. Further columns are ignored.

    A round is one scan: each task sends a row of sums per centroid, whatever the number of vectors, and k x dims sums reach the
    driver. No vector is shuffled; copies, however many, stay in the tasks that read them.
    """
    kept = scaled(vectors, id_col, vec_col, dims, scale)
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids.reshape(0, dims)
    order = by_variance(kept, dims)
    for _ in range(rounds):
        parts = kept.select("x").mapInArrow(_sums(centroids, order), "cluster int, n long, total array<long>")
        each = parts.select("cluster", "n", F.posexplode("total").alias("d", "part"))
        sums = each.groupBy("cluster", "d").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
        centroids = centroids.copy()
        for r in sums:
            centroids[r["cluster"], r["d"]] = int(r["total"]) // int(r["n"])
    return kept.mapInArrow(_assign(centroids, order), "vec_id long, cluster int, distance long"), centroids


def clusters(vectors: DataFrame, **settings) -> DataFrame:
    """The assignment of :func:`kmeans` with ``cluster_inertia`` and ``inertia`` (null where a sum exceeds a long) and ``centroid_sha256``.

    The assignment is written once and read for the sums and the result; what is joined to it is a row per centroid.
    """
    spark = vectors.sparkSession
    assigned, centroids = kmeans(vectors, **settings)
    assigned = written(assigned, "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda v: v if v < 1 << 63 else None
    rows = [(c, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(sums.items())]
    return assigned.join(F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(read_table(spark, sf_dir, "embeddings"))


def op11_sql() -> str:
    """The same rounds as chained common tables."""
    rounds = []
    for r in range(4):
        rounds.append(f"""pairs{r} AS (SELECT v.vec_id, v.x, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance FROM kept v CROSS JOIN cent{r} c),
            near{r} AS MATERIALIZED (SELECT vec_id, x, cluster, distance FROM pairs{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if r < 3:
            rounds.append(f"""mean{r} AS (SELECT cluster, list(m ORDER BY d) AS x FROM (SELECT cluster, d, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS m FROM (SELECT cluster, unnest(x) AS v, unnest(range(1, 65)) AS d FROM near{r}) GROUP BY cluster, d) GROUP BY cluster),
            cent{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM cent{r} c LEFT JOIN mean{r} m USING (cluster))""")
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * v::DOUBLE) AS BIGINT)) AS x FROM embeddings
                WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
            cent0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1)::INT AS cluster, x FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16),
            {", ".join(rounds)}
        SELECT vec_id, n.cluster, distance, (sum(distance) OVER (PARTITION BY n.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM near3 n JOIN cent3 c USING (cluster)"""
