"""Centroid clustering whose assignments are found by the threshold algorithm.

Lloyd's rounds over vectors of whole numbers.  For every dimension the centroids are kept in
a list sorted by their component there.  A vector starts in each list at its own value and
walks outward; a list's frontier is the nearest component of a centroid that the vector has
not met yet.  Meeting a centroid, it takes the exact squared distance to it.  The squared
frontier distances of all lists sum up to a bound that no unmet centroid can undercut, and
the walk stops once this sum strictly exceeds the best exact distance (on equality an unmet
centroid could still be as near and have a smaller number).  Lists are walked in the order
of how far apart their centroids lie, for those raise the bound most, and a met centroid
is passed over in the other lists.

Vectors are staged once as whole numbers.  A round is one pass over them; what leaves a task
are the sums of its vectors per cluster and dimension, which Spark adds up.  The driver
holds the centroids and their sums: the number of clusters times that of dimensions, both
parameters, whatever the number of vectors.

Defined results: vectors that are null, hold a null or non-finite component or have another
number of components take no part; rows that repeat are vectors each; a vector without id
is clustered, and starts no cluster while there are enough others; equal hashes at the
start are ordered by the vectors; with fewer vectors than clusters there are as many
clusters as vectors; an empty table gives no rows; components beyond 64 bits are cut to the
ends of that range, distances and sums of them beyond it are null, assignments are exact;
other columns, of whatever name, are not looked at, texts among them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table

SLICE = 2048  # vectors that are walked at once
SAFE = 1 << 25  # components below this, and their sums of squares, are exact in 64 bits
LONGEST = 1024  # dimensions up to which that holds
LONG_MAX = (1 << 63) - 1
HALF = 1 << 60


class Lists:
    """The centroids' components, sorted per dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.count, self.width = centroids.shape
        order = np.argsort(centroids, axis=0, kind="stable")
        spread = [int(v) for v in centroids.max(axis=0) - centroids.min(axis=0)]
        # lists whose centroids lie far apart raise the bound most
        self.dims = sorted(range(self.width), key=lambda d: -spread[d])
        self.order = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(centroids, order, axis=0).T)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance, centroids met) per vector."""
        rows = len(vectors)
        met = np.zeros((rows, self.count), dtype=bool)
        best = np.zeros(rows, dtype=vectors.dtype)
        found = np.full(rows, -1, dtype=np.int64)
        # left: the next list place below the value, right: the next one at or above it
        right = np.stack([np.searchsorted(self.values[d], vectors[:, d]) for d in range(self.width)], axis=1)
        left = right - 1
        live, turn = np.arange(rows), 0
        while len(live):
            dim = self.dims[turn % self.width]
            turn += 1
            side = self._frontier(vectors, met, left, right, live, dim)[1]
            place = np.where(side, right[live, dim], left[live, dim])
            number = self.order[dim][place]
            met[live, number] = True
            gap = vectors[live] - self.centroids[number]
            exact = (gap * gap).sum(axis=1)
            better = (found[live] < 0) | (exact < best[live]) | ((exact == best[live]) & (number < found[live]))
            best[live[better]], found[live[better]] = exact[better], number[better]
            live = live[~met[live].all(axis=1)]
            bound = np.zeros(len(live), dtype=vectors.dtype)
            for d in self.dims:
                if not len(live):
                    break
                gap = self._frontier(vectors, met, left, right, live, d)[0]
                bound += gap * gap
                # a part of the sum that exceeds already is enough
                going = ~(bound > best[live])
                live, bound = live[going], bound[going]
        return found, best, met.sum(axis=1)

    def _frontier(self, vectors, met, left, right, live, dim) -> tuple[np.ndarray, np.ndarray]:
        """(distance to the nearest unmet component, whether it lies above), moving past met ones.

        Every vector in ``live`` has an unmet centroid.
        """
        order, values = self.order[dim], self.values[dim]
        low, high = left[live, dim], right[live, dim]
        while True:
            past = (low >= 0) & met[live, order[low]]
            if not past.any():
                break
            low = low - past
        while True:
            past = high < self.count
            past &= met[live, order[np.where(past, high, 0)]]
            if not past.any():
                break
            high = high + past
        left[live, dim], right[live, dim] = low, high
        value = vectors[live, dim]
        below = value - values[np.maximum(low, 0)]
        above = values[np.minimum(high, self.count - 1)] - value
        side = (low < 0) | ((high < self.count) & (above < below))
        return np.where(side, above, below), side


def small(values: np.ndarray) -> bool:
    return bool(((values < SAFE) & (values > -SAFE)).all())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; of Python's own numbers where 64 bits could be too few."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(column), width)
    return rows if small(flat) and width <= LONGEST else rows.astype(object)


def slices(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]):
    """(rows of a slice, its vectors, numbers, distances, centroids met) for all vectors of a task."""
    plain = np.array(centroids, dtype=np.int64)
    lists = Lists(plain) if small(plain) and plain.shape[1] <= LONGEST else None
    exact = None
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            vectors = matrix(part.column("vector"), plain.shape[1])
            if lists and vectors.dtype != object:
                yield part, vectors, *lists.nearest(vectors)
            else:
                exact = exact or Lists(plain.astype(object))
                yield part, vectors, *exact.nearest(vectors.astype(object))


def _long(value) -> int | None:
    return int(value) if value <= LONG_MAX else None


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance, met): ``met`` counts the centroids whose distance was taken."""

    def run(batches):
        for part, _, number, distance, met in slices(batches, centroids):
            yield pa.record_batch({
                "id": part.column("id"), "cluster": pa.array(number, pa.int32()),
                "distance": pa.array([_long(d) for d in distance], pa.int64()), "met": pa.array(met, pa.int32())})

    return vectors.mapInArrow(run, "id long, cluster int, distance long, met int")


def sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, dim, high, low, n): sums of the vectors of every cluster; dim -1 sums distances.

    A sum is ``high * HALF + low``, so that sums of any size come out whole.
    """

    def run(batches):
        totals: dict[int, list] = {}
        for _, rows, number, distance, _ in slices(batches, centroids):
            for k in np.unique(number):
                mine = number == k
                # slices are short enough for sums of safe numbers to be exact
                added = [int(v) for v in rows[mine].sum(axis=0)]
                added.append(sum(int(d) for d in distance[mine]))
                held = totals.setdefault(int(k), [0, [0] * len(added)])
                held[0] += int(mine.sum())
                held[1] = [a + b for a, b in zip(held[1], added)]
        out = [(k, d if d < len(t) - 1 else -1, str(v // HALF), v % HALF, n) for k, (n, t) in totals.items() for d, v in enumerate(t)]
        if out:
            names = ("cluster", "dim", "high", "low", "n")
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch({c: pa.array(v, t) for c, v, t in zip(names, zip(*out), kinds)})

    parts = vectors.mapInArrow(run, "cluster int, dim int, high string, low long, n long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c)
    return parts.groupBy("cluster", "dim").agg(whole("high"), whole("low"), F.sum("n").alias("n"))


def total(row) -> int:
    return int(row.high) * HALF + int(row.low)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> list[list[int]]:
    """The vectors with the least hashes of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    return [list(r.vector) for r in vectors.orderBy(key.asc_nulls_last(), "vector").limit(count).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    out = [list(c) for c in centroids]
    for r in sums(vectors, centroids).filter("dim >= 0").collect():
        out[r.cluster][r.dim] = total(r) // r.n
    return out


def clustered(vectors: DataFrame, count: int, rounds: int, seed: int) -> DataFrame:
    """(id, cluster, distance, met, cluster_inertia, inertia, centroid_sha256) of every vector.

    ``vectors`` holds (id long, vector array<long>) with vectors of one length, read afresh
    in every round: pass a stored table.
    """
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, count, seed)
    if not centroids:
        return spark.createDataFrame([], (
            "id long, cluster int, distance long, met int, cluster_inertia long, inertia long, centroid_sha256 string"))
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    inertia = {r.cluster: total(r) for r in sums(vectors, centroids).filter("dim = -1").collect()}
    whole = sum(inertia.values())
    told = spark.createDataFrame(
        [(k, _long(inertia.get(k, 0)), _long(whole), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for k, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per cluster, so its size is the parameter's
    return assigned(vectors, centroids).join(F.broadcast(told), "cluster").select(
        "id", "cluster", "distance", "met", "cluster_inertia", "inertia", "centroid_sha256")


def whole_vectors(embeddings: DataFrame, width: int, scale: int) -> DataFrame:
    """(id, vector): floor(scale * x) of every component, of the vectors that take part."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.filter((F.size("x") == width) & finite).select(
        "id", F.transform("x", lambda v: F.floor(v * scale)).alias("vector"))


def op12_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in eight clusters after ten rounds."""
    vectors = staged(whole_vectors(table(spark, sf_dir, "embeddings"), 64, 1024), "op12-vectors")
    return clustered(vectors, 8, 10, 3).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _nearest_sql(number: int) -> str:
    return f"""a{number} AS MATERIALIZED (SELECT rid, min({{'d': d, 'k': k}}) AS b FROM (
  SELECT rid, k, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.e, c.e)])::BIGINT AS d
  FROM v, c{number} c) GROUP BY rid)"""


def _moved_sql(number: int) -> str:
    return f"""c{number + 1} AS MATERIALIZED (SELECT k, coalesce(m, c.e) AS e FROM c{number} c LEFT JOIN (
  SELECT k, list(e ORDER BY dim) AS m FROM (
    SELECT b.k AS k, dim, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS e
    FROM a{number} JOIN x USING (rid) GROUP BY 1, 2) GROUP BY k) USING (k))"""


OP12_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT rid, generate_subscripts(e, 1) AS dim, unnest(e) AS x FROM v),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS k, e FROM v
  QUALIFY k < 8),
{", ".join(f"{_nearest_sql(n)}, {_moved_sql(n)}" for n in range(10))}, {_nearest_sql(10)}
SELECT vec_id, b.k::INTEGER AS cluster, b.d AS distance, (sum(b.d) OVER (PARTITION BY b.k))::BIGINT AS cluster_inertia,
  (sum(b.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c10.e, ',')) AS centroid_sha256
FROM a10 JOIN v USING (rid) JOIN c10 ON c10.k = b.k"""
