"""Nearest-centroid clustering in whole numbers, with a vantage-point tree over the centroids.

Every component x of a vector becomes floor(steps * x). The centroids start as the vectors with the least hashes of their
ids. Each round builds a vantage-point tree over them, broadcasts it, and finds every vector's nearest centroid by
best-first branch and bound: the open node of least bound is next, and a node is left out only if its bound is above
the best distance so far, not if it equals it, so a tie is always seen and goes to the smaller number. Distances are
whole numbers; bounds alone are floating point, with room for their rounding. Tasks send a sum for each cluster and
component; the driver sees k * dims sums a round, whatever the input holds.

Kept are vectors with exactly `dims` components, none null or non-finite; others are in no result, and an empty table gives
an empty one. With fewer than k vectors there are fewer clusters. Rows without id are clustered but never chosen
as first centroids; rows that repeat an id, a vector or both are rows of their own, ordered by id hash and then
components. Other columns go. A component beyond 2^27 steps raises an error, as distances would not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import landed

#: Constants of the query.
CLUSTERS, ROUNDS, DIMS, STEPS, SALT = 40, 5, 64, 256, "2:"

LEAF = 6
MOST = 1 << 27
#: Up to here sums of products are exact in floating point, for 64 components.
EXACT = 1 << 22
ROWS = 4096


@dataclass
class Tree:
    """Nodes of a vantage-point tree; a node's own points are its leaf, or its vantage point."""

    points: np.ndarray
    own: list[np.ndarray]
    #: For each node its children with the least and largest distance of their points from its vantage point.
    children: list[list[tuple[int, float, float]]]


def build_tree(points: np.ndarray) -> Tree:
    """A tree over the rows of `points`; halves at the median distance from a vantage point far from the others."""
    tree = Tree(points, [], [])

    def node(members: np.ndarray) -> int:
        number = len(tree.own)
        tree.own.append(members)
        tree.children.append([])
        if len(members) > LEAF:
            middle = points[members].mean(axis=0)
            far = int(np.argmax(((points[members] - middle) ** 2).sum(axis=1)))
            rest = np.delete(members, far)
            apart = distances(points[rest], points[members[far : far + 1]])[:, 0]
            order = np.argsort(apart, kind="stable")
            tree.own[number] = members[far : far + 1]
            for half in np.array_split(order, 2):
                ends = np.sqrt(apart[half].astype(float))
                tree.children[number].append((node(np.sort(rest[half])), float(ends.min()), float(ends.max())))
        return number

    node(np.arange(len(points)))
    return tree


def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector from every point."""
    if max(np.abs(vectors).max(initial=0), np.abs(points).max(initial=0)) <= EXACT and vectors.shape[1] <= DIMS:
        a, b = vectors.astype(float), points.astype(float)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((vectors - point) ** 2).sum(axis=1) for point in points], axis=1)


def nearest(vectors: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of its nearest point, the smaller one of equals, and the squared distance."""
    size = len(vectors)
    best = np.full(size, np.iinfo(np.int64).max)
    which = np.full(size, len(tree.points))
    bound = np.full((size, len(tree.own)), np.inf)
    bound[:, 0] = 0
    live = np.arange(size)
    while len(live):
        at = bound[live].argmin(axis=1)
        least = bound[live, at]
        go = least <= np.sqrt(best[live].astype(float)) * (1 + 1e-12)
        go &= np.isfinite(least)
        live, at = live[go], at[go]
        for number in np.unique(at).tolist():
            rows = live[at == number]
            own = tree.own[number]
            found = distances(vectors[rows], tree.points[own])
            first = found.argmin(axis=1)
            value, name = found[np.arange(len(rows)), first], own[first]
            better = (value < best[rows]) | ((value == best[rows]) & (name < which[rows]))
            best[rows[better]], which[rows[better]] = value[better], name[better]
            away = np.sqrt(found[:, 0].astype(float))
            for child, near, far in tree.children[number]:
                gap = np.maximum(near - away, away - far) - 1e-12 * (away + far)
                bound[rows, child] = np.maximum(np.maximum(gap, bound[rows, number]), 0)
            bound[rows, number] = np.inf
    return which, best


def kept_vectors(vectors: DataFrame, vec_id: str, vector: str, dims: int = DIMS, steps: int = STEPS) -> DataFrame:
    """vec_id and whole-number components of the vectors that count."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(steps) * x.cast("double")))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    fits = F.forall(F.col(vector), lambda x: F.abs(F.lit(steps) * x.cast("double")) <= MOST)
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"component beyond {MOST} steps")).cast("array<bigint>"))
    return vectors.where((F.size(vector) == dims) & finite).select(F.col(vec_id).cast("long").alias("vec_id"), checked.alias("components"))


def first_centroids(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the least hash of salt and id; k rows reach the driver."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id is not null").orderBy(digest, "components").limit(k).collect()
    return np.array([r["components"] for r in rows], np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("components").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def cluster_sums(kept: DataFrame, tree: Tree, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Of every non-empty cluster the number of vectors and the sum of each component."""
    sent, k = kept.sparkSession.sparkContext.broadcast(tree), len(tree.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, values in _blocks(batches, dims):
            which, _ = nearest(values, sent.value)
            order = np.argsort(which, kind="stable")
            names, firsts = np.unique(which[order], return_index=True)
            sums[names] += np.add.reduceat(values[order], firsts, axis=0)
            counts += np.bincount(which, minlength=k)
        full = np.flatnonzero(counts)
        columns = [np.repeat(full, dims), np.tile(np.arange(dims), len(full)), np.repeat(counts[full], dims), sums[full].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "place", "n", "total"])

    parts = kept.select("components").mapInArrow(run, "cluster long, place long, n long, total long")
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    rows = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), whole).orderBy("cluster", "place").collect()
    sent.unpersist()
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        found.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return found


def assigned(kept: DataFrame, tree: Tree, dims: int) -> DataFrame:
    """vec_id, cluster, distance."""
    sent = kept.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in _blocks(batches, dims):
            which, best = nearest(values, sent.value)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(which.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    dims: int = DIMS, steps: int = STEPS, salt: str = SALT,
) -> tuple[DataFrame, DataFrame]:
    """Vectors (vec_id, cluster, distance) and clusters (cluster, n, inertia, centroid), the second of k rows at most."""
    spark = vectors.sparkSession
    kept = landed(kept_vectors(vectors, vec_id, vector, dims, steps), "vectors")
    centroids = first_centroids(kept, k, salt)
    schema = "cluster int, n long, inertia decimal(38,0), centroid array<bigint>"
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), spark.createDataFrame([], schema)
    for _ in range(rounds):
        for number, (n, totals) in cluster_sums(kept, build_tree(centroids), dims).items():
            centroids[number] = [total // n for total in totals]
    found = landed(assigned(kept, build_tree(centroids), dims), "clusters")
    sums = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    by = {r["cluster"]: (r["n"], r["inertia"]) for r in sums.collect()}
    rows = [(number, *by.get(number, (0, 0)), centroid) for number, centroid in enumerate(centroids.tolist())]
    rows = [(number, n, inertia if n else None, centroid) for number, n, inertia, centroid in rows]
    return found, spark.createDataFrame(rows, schema)


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, steps: int = STEPS, salt: str = SALT) -> str:
    """The rows of the query, for ids that are present and distinct."""
    squares = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps_of = []
    for r in range(rounds + 1):
        steps_of.append(f"""near{r} AS MATERIALIZED (
            SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
            FROM (SELECT v.vec_id, v.x, c.cluster, CAST({squares} AS BIGINT) AS d FROM vectors v CROSS JOIN centroids{r} c) GROUP BY vec_id, x)""")
        steps_of.append(f"""moved{r} AS MATERIALIZED (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM (
                SELECT cluster, place, CAST(sum(value) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT cluster, unnest(x) AS value, generate_subscripts(x, 1) AS place FROM near{r}) GROUP BY cluster, place)
            GROUP BY cluster)""")
        steps_of.append(f"centroids{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM centroids{r} c LEFT JOIN moved{r} m USING (cluster))")
    return f"""
    WITH vectors AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({steps} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
    centroids0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY sha256('{salt}' || vec_id)) - 1 AS INTEGER) AS cluster, x
        FROM (SELECT * FROM vectors WHERE vec_id IS NOT NULL ORDER BY sha256('{salt}' || vec_id) LIMIT {k})),
    {", ".join(steps_of[:-2])}
    SELECT n.vec_id, n.cluster, n.d AS distance, CAST(sum(n.d) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
        CAST(sum(n.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM near{rounds} n JOIN centroids{rounds} c USING (cluster)"""
