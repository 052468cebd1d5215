"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks of bounded size.  A block keeps, for every dimension, its
rows sorted by that component.  A query walks all lists at once, from the end that raises
its score; every row it meets is scored in full.  The sum of the query's products with the
components at the current depth bounds the score of all rows not met yet; the walk ends
when that bound is below the kth score found.  Equal scores could still come up at the
bound itself, so it goes on there.

The query set is cut into blocks as well; every pair of blocks is one group, and the k
best of all groups are merged per query.  No task holds more than two blocks.  Both sides
are written with their numbers before they are dealt, so that every task, a repeated one
too, finds a row in the same block.

How much a walk saves is the data's: where components are independent and as many as 64,
the bound falls so slowly that all rows of a block are met before it ends.

Defined results: a null vector, and one with a null or non-finite component, takes no
part; vectors of different length are compared as if the shorter one ended in zeros; rows
with a null vec_id take no part; rows that repeat are candidates each, except for queries
of the same vec_id; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table

ROWS = 8192  # rows of a block, about
QUERIES = 1024  # queries of a block, about
STEP = 32  # first depth of a walk; it doubles
PART = "query_id long, vec_id long, score long"


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of integers; shorter vectors are filled with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


class Block:
    """Rows of a block with their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        # products of whole numbers are exact in doubles as long as they stay below 2**53
        self.exact = not len(vectors) or int(np.abs(vectors).max()) ** 2 * max(vectors.shape[1], 1) < 1 << 53
        self.vectors = vectors.astype(np.float64) if self.exact else vectors
        self.order = np.argsort(-vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, equal scores by id; the threshold algorithm."""
        count = len(self.ids)
        query = query.astype(self.vectors.dtype)
        dims = np.flatnonzero(query)
        up = query[dims] > 0
        seen = np.zeros(count, dtype=bool)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype)
        depth, step = 0, STEP
        while depth < count:
            until = min(count, depth + step)
            rising, falling = dims[up], dims[~up]
            met = np.concatenate([
                self.order[depth:until, rising].ravel(), self.order[count - until : count - depth, falling].ravel()])
            fresh = np.zeros(count, dtype=bool)
            fresh[met] = True
            fresh &= ~seen
            # with nothing to walk along, all rows score zero and are looked at
            new = np.flatnonzero(fresh) if len(dims) else np.flatnonzero(~seen)
            seen[new] = True
            new = new[self.ids[new] != query_id]
            ids = np.concatenate([ids, self.ids[new]])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            depth, step = until, step * 2
            bound = query[rising] @ self.sorted[until - 1, rising] + query[falling] @ self.sorted[count - until, falling]
            if seen.all() or (len(scores) == k and bound < scores[-1]):
                break
        return ids, scores


def dealt(rows: DataFrame, size: int, column: str) -> tuple[DataFrame, int]:
    """Rows with the number of a block of about ``size``, and the number of blocks."""
    numbered = staged(rows.withColumn("_n", F.monotonically_increasing_id()), f"search-{column}")
    blocks = max(1, math.ceil(numbered.count() / size))
    return numbered.withColumn(column, F.pmod(F.xxhash64("_n"), F.lit(blocks)).cast("int")).drop("_n"), blocks


def searched(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for every query.

    Both sides: (id long, vector array<long>); a row whose id is the query's is left out.
    """
    rows, blocks = dealt(rows, ROWS, "block")
    queries, parts = dealt(queries, QUERIES, "part")
    # each side once per block of the other
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.withColumn("part", every(parts))
    right = queries.withColumn("block", every(blocks)).select(
        *[F.col(c).alias(f"q_{c}") for c in ("id", "vector", "block", "part")])

    def best(data: pa.Table, asked: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(data) and len(asked):
            vectors, wanted = matrix(data.column("vector")), matrix(asked.column("q_vector"))
            width = max(vectors.shape[1], wanted.shape[1])
            vectors, wanted = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (vectors, wanted))
            block = Block(data.column("id").to_numpy(), vectors)
            for query_id, query in zip(asked.column("q_id").to_pylist(), wanted):
                ids, scores = block.top(query_id, query, k)
                out[0].append(np.full(len(ids), query_id))
                out[1].append(ids)
                out[2].append(np.rint(scores).astype(np.int64) if block.exact else scores)
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    found = left.groupBy("block", "part").cogroup(right.groupBy("q_block", "q_part")).applyInArrow(best, PART)
    first = F.struct((-F.col("score")).alias("worse"), "vec_id")
    top = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(first)), 1, k).alias("best"))
    ranked = top.select("query_id", F.posexplode("best").alias("place", "hit"))
    return ranked.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.worse")).alias("score"))


def whole_numbers(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(id, vector): floor(scale * x) of every component of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.filter(F.col("id").isNotNull() & finite).select(
        "id", F.transform("x", lambda v: F.floor(v * scale)).alias("vector"))


def op6_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every vector whose id is divisible by 50."""
    rows = whole_numbers(table(spark, sf_dir, "embeddings"))
    return searched(rows, rows.filter(F.col("id") % 50 == 0), 5)


OP6_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
