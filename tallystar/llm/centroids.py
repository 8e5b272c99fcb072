"""Clustering of embeddings around centroids, in whole numbers, with most distances ruled out beforehand."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.tables import plain, table
from tallystar.llm.vectors import matrices, sums
from tallystar.sources.scratch import pin

CENTROIDS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = "3"
#: Rotated coordinates that are stored; the rest of a vector is told by its length alone.
STORED = 16
#: Beyond this an entry counts as not finite: squared distances of 64 entries must fit a long.
MOST = 2**27 / SCALE
#: How far stored coordinates may be off, as a share of a vector's length: single precision, and rounding of the rotation.
_OFF = 2.0**-20


def whole(matrix: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * matrix).astype(np.int64)


class Rotation:
    """The principal axes of vectors; coordinates on the first of them, and the length of what is left."""

    def __init__(self, n: int, moments: np.ndarray, dims: int, stored: int):
        self.mean = moments[:dims] / n
        second = moments[dims:].reshape(dims, dims) / n - np.outer(self.mean, self.mean)
        self.axes = np.linalg.eigh(second)[1].T[::-1].copy()
        self.stored = min(stored, dims)

    def outline(self, y: np.ndarray) -> np.ndarray:
        """Leading coordinates, and the length of the others in the last column."""
        turned = (y - self.mean) @ self.axes.T
        return np.column_stack([turned[:, : self.stored], np.linalg.norm(turned[:, self.stored :], axis=1)])


def nearest(y: np.ndarray, outlines: np.ndarray, centroids: np.ndarray, centroid_outlines: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row and the squared distance to it, and how many distances were computed.

    The distance of two vectors is at least that of their outlines: projected distance squared plus squared difference of the
    residual lengths. The centroid with the nearest outline is computed first, in whole numbers, and then all that the bound, less
    what rounding may have added, does not put behind it. Of equal distances the smaller number wins.
    """
    o, c = outlines.astype(np.float64), centroid_outlines
    apart = np.sqrt(np.maximum((o * o).sum(axis=1)[:, None] - 2 * (o @ c.T) + (c * c).sum(axis=1)[None, :], 0))
    lengths, of_centroids = np.linalg.norm(o, axis=1), np.linalg.norm(c, axis=1)
    # The expanded square loses half the digits where both are long and near; the second term allows for it.
    bound = apart - _OFF * (lengths[:, None] + of_centroids[None, :])
    cluster = apart.argmin(axis=1)
    best = ((y - centroids[cluster]) ** 2).sum(axis=1)
    first, computed = cluster.copy(), len(y)
    possible = bound <= np.sqrt(best.astype(np.float64))[:, None] * (1 + 1e-12)
    for k in range(len(centroids)):
        rows = np.flatnonzero(possible[:, k] & (first != k))
        computed += len(rows)
        distance = ((y[rows] - centroids[k]) ** 2).sum(axis=1)
        better = (distance < best[rows]) | ((distance == best[rows]) & (k < cluster[rows]))
        cluster[rows[better]], best[rows[better]] = k, distance[better]
    return cluster, best, computed


def _rows(batch: pa.RecordBatch, dims: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column("y").flatten().to_numpy().astype(np.int64).reshape(-1, dims)
    return y, batch.column("outline").flatten().to_numpy().reshape(-1, width)


def _assigned(stored: DataFrame, rotation: Rotation, centroids: np.ndarray) -> DataFrame:
    outlines, dims, width = rotation.outline(centroids), centroids.shape[1], rotation.stored + 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = nearest(*_rows(batch, dims, width), centroids, outlines)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return stored.mapInArrow(assign, "id long, cluster int, distance long")


def _moved(stored: DataFrame, rotation: Rotation, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: means of their vectors, rounded down; one without vectors stays."""
    outlines, (k, dims), width = rotation.outline(centroids), centroids.shape, rotation.stored + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            y, o = _rows(batch, dims, width)
            cluster = nearest(y, o, centroids, outlines)[0]
            order = np.argsort(cluster, kind="stable")
            some, first = np.unique(cluster[order], return_index=True)
            if len(some):
                total[some, :dims] += np.add.reduceat(y[order], first, axis=0)
                total[some, dims] += np.diff(np.append(first, len(y)))
        cluster, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(at), pa.array(total[cluster, at])], ["cluster", "at", "value"])

    # Numbers of centroids times dimensions: parameters, not rows of the table.
    added = stored.mapInArrow(add, "cluster long, at long, value long").groupBy("cluster", "at").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros((k, dims + 1), np.int64)
    total[added.column("cluster").to_numpy(), added.column("at").to_numpy()] = added.column("value").to_numpy()
    n = total[:, dims:]
    return np.where(n > 0, total[:, :dims] // np.maximum(n, 1), centroids)


def cluster(
    embeddings: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per vector its cluster, its squared distance and figures of the clusters.

    Kept are vectors of exactly ``dimensions`` entries, none null or non-finite; each entry x becomes ``floor(1024 x)``. The
    centroids start as the kept vectors with the smallest sha256 of ``seed:id``, in that order. A round assigns every vector
    to its nearest centroid (of equal ones the smaller number) and moves each centroid that has vectors to their mean, rounded down. After
    the rounds vectors are assigned once more. Columns: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia`` and ``inertia`` (sums of
    distances), ``centroid_sha256`` (of the final centroid's entries joined by commas).

    How: the principal axes come from sums over all vectors. Each vector is written once, as whole numbers with its leading rotated
    coordinates and the length of the rest; a round rules out centroids by these and computes the others
    in whole numbers (``nearest``). Tasks send sums by centroid, never rows.

    With fewer kept vectors than centroids there are as many centroids as vectors. Repeated rows and rows that share an id are
    vectors of their own, also as first centroids (then in order of their entries); a null id is hashed as an empty one. Entries beyond
    2^17 in size count as not finite; sums of distances beyond a long stop the job. Other columns are not read; an empty table gives an
    empty result.
    """
    if min(centroids, dimensions) < 1 or rounds < 0:
        raise ValueError("centroids and dimensions are at least one, rounds not negative")
    spark = embeddings.sparkSession
    rows = embeddings.select(plain(key).cast("long").alias("id"), plain(vector).cast("array<double>").alias("vector")).where(F.size("vector") == dimensions)

    def moments(m: np.ndarray) -> np.ndarray:
        y = whole(m).astype(np.float64)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    fitted = sums(rows.select("vector"), moments, MOST, "double").get(dimensions)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if fitted is None:
        return spark.createDataFrame([], schema)
    rotation = Rotation(*fitted, dimensions, STORED)

    def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column(1), MOST):
                y = whole(matrix)
                o = rotation.outline(y).astype(np.float32)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]) for x in (y.astype(np.int32), o)]
                lists = [x.cast(pa.list_(x.type.value_type)) for x in lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *lists], ["id", "y", "outline"])

    stored = pin(rows.mapInArrow(outlined, "id long, y array<int>, outline array<float>"))
    named = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = stored.orderBy(named, "y").limit(centroids).select("y").collect()
    centre = np.array([row.y for row in start], np.int64)
    for _ in range(rounds):
        centre = _moved(stored, rotation, centre)
    assigned = pin(_assigned(stored, rotation, centre))
    inertia = {row.cluster: row.inertia for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre.tolist()]
    # One row per centroid.
    figures = spark.createDataFrame([(k, n, sum(inertia.values()), digest[k]) for k, n in inertia.items()], "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(figures), F.col("cluster") == F.col("c")).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    rounds = "".join(
        f""",
d{r} as materialized (select p.row, c.k, sum((p.v - c.v) * (p.v - c.v)) as distance from points p join c{r} c on c.i = p.i group by p.row, c.k),
a{r} as materialized (select row, k, distance from d{r} qualify row_number() over (partition by row order by distance, k) = 1)"""
        + (
            f""",
m{r} as (select a.k, p.i, sum(p.v) as s, count(*) as n from a{r} a join points p on p.row = a.row group by a.k, p.i),
c{r + 1} as materialized (select c.k, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v)::bigint as v from c{r} c left join m{r} m on m.k = c.k and m.i = c.i)"""
            if r < ROUNDS
            else ""
        )
        for r in range(ROUNDS + 1)
    )
    return f"""
with kept as materialized (
    select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as y from embeddings
    where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
points as materialized (select row, unnest(y) as v, unnest(range({DIMENSIONS})) as i from kept),
first as (select row, row_number() over (order by sha256('{SEED}:' || vec_id)) - 1 as k from kept qualify k < {CENTROIDS}),
c0 as materialized (select f.k, p.i, p.v from first f join points p on p.row = f.row){rounds},
inertia as (select k, sum(distance) as own, sum(sum(distance)) over () as total from a{ROUNDS} group by k),
digest as (select k, sha256(string_agg(v::varchar, ',' order by i)) as hex from c{ROUNDS} group by k)
select kept.vec_id, a.k::int as cluster, a.distance::bigint as distance, n.own::bigint as cluster_inertia, n.total::bigint as inertia, g.hex as centroid_sha256
from a{ROUNDS} a join kept on kept.row = a.row join inertia n on n.k = a.k join digest g on g.k = a.k
"""


ORACLE = _oracle()
