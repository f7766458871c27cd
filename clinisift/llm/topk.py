"""Exact top-k search by inner product with pivot-table elimination."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinisift.session import materialize

from .common import tidy_batches, tidy_group

#: Pivots: the vectors with the smallest hashes, so many per dimension count at most.
PIVOTS = 24
#: Rows of the pivot table in one block, and queries in one block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 512
#: Candidates that are scored before the stopping rule is tried again.
STEP = 64


def whole_numbers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double, or null if a component is null or not finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale)))


def pivot_table(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """id, v (whole numbers), dim, norm2, dist (distance to each pivot of its dimension), block; written once.

    The pivots, at most ``pivots`` vectors of each of the few dimensions, are the only rows
    that pass through the driver. ``block`` deals the rows out evenly by a hash of the id.
    """
    rows = vectors.select(F.col(id_col).alias("id"), whole_numbers(F.col(vec_col)).alias("v")).filter("v IS NOT NULL AND id IS NOT NULL")
    rows = rows.withColumn("dim", F.size("v"))
    counts = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(16).collect()
    chosen: dict[int, list[list[int]]] = {}
    for dim in [r["dim"] for r in counts]:  # rarer dimensions do without pivots: their bound is the norms'
        picked = rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
        chosen[dim] = [r["v"] for r in picked]
    blocks = max(1, math.ceil(sum(r["count"] for r in counts) / block_rows))

    def run(batches):
        for b in batches:
            ids, dims = b.column(0), b.column(2).to_numpy()
            values, at = b.column(1).flatten().to_numpy(), 0
            norms, dists = np.zeros(b.num_rows), []
            for k, d in enumerate(dims.tolist()):
                x = values[at:at + d].astype(np.float64)
                at += d
                norms[k] = x @ x
                p = chosen.get(d)
                dists.append(np.sqrt(((np.array(p, np.float64).reshape(len(p), d) - x) ** 2).sum(axis=1)) if p else np.empty(0))
            yield pa.RecordBatch.from_arrays(
                [ids, b.column(1), b.column(2), pa.array(norms), pa.array(dists, pa.list_(pa.float64()))], ["id", "v", "dim", "norm2", "dist"])

    kind = rows.schema["id"].dataType.simpleString()
    table = rows.mapInArrow(tidy_batches(run), f"id {kind}, v array<bigint>, dim int, norm2 double, dist array<double>")
    return materialize(table.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "pivot-table")


def _matrix(column, dim: int, kind) -> np.ndarray:
    rows = len(column)
    column = column.combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, dim)


def best_of_block(queries: pa.Table, data: pa.Table, k: int) -> pa.Table:
    """The k best rows of one block of the pivot table for each query of one block.

    |d(q, p) - d(x, p)| is at most d(q, x) for every pivot p; the largest of them bounds the
    distance from below and so the inner product (|q|^2 + |x|^2 - d^2) / 2 from above. Rows
    are scored in order of their bounds until the k-th best score beats the next bound.
    """
    out: list[tuple] = []
    if queries.num_rows and data.num_rows:
        dim = data.column("dim")[0].as_py()
        q, x = (_matrix(t.column("v"), dim, np.int64) for t in (queries, data))
        n_pivots = len(data.column("dist")[0])
        dq, dx = (_matrix(t.column("dist"), n_pivots, np.float64) if n_pivots else np.zeros((t.num_rows, 0)) for t in (queries, data))
        nq, nx = (t.column("norm2").to_numpy() for t in (queries, data))
        q_ids, x_ids = queries.column("id").to_numpy(), data.column("id").to_numpy()
        largest = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(x).max(initial=0))) * max(dim, 1)
        if largest < 2**53:  # exact in doubles
            q, x = q.astype(np.float64), x.astype(np.float64)
        columns = np.ascontiguousarray(dx.T)
        low, gap = np.empty(len(x)), np.empty(len(x))
        for i in range(len(q)):
            low[:] = 0
            for p in range(n_pivots):
                np.subtract(columns[p], dq[i, p], out=gap)
                np.abs(gap, out=gap)
                np.maximum(low, gap, out=low)
            # Rounding of square roots and squares must not cut a true candidate.
            low *= 1 - 1e-9
            bound = np.minimum((nq[i] + nx - low * low) / 2, np.sqrt(nq[i]) * np.sqrt(nx))
            bound += 1e-9 * (nq[i] + nx) + 1e-6
            bound[x_ids == q_ids[i]] = -np.inf
            best_s, best_x = np.empty(0, x.dtype), np.empty(0, x_ids.dtype)
            left = np.arange(len(x))
            take = STEP
            while len(left):
                some = left if len(left) <= take else left[np.argpartition(-bound[left], take - 1)[:take]]
                some = some[bound[some] > -np.inf]
                scores = x[some] @ q[i]
                best_s, best_x = np.r_[best_s, scores], np.r_[best_x, x_ids[some]]
                order = np.lexsort((best_x, -best_s))[:k]
                best_s, best_x = best_s[order], best_x[order]
                bound[some] = -np.inf
                floor = best_s[-1] if len(best_s) == k else -np.inf
                left = left[(bound[left] > -np.inf) & (bound[left] >= floor)]
                take *= 2
            out += [(q_ids[i], v, int(s)) for v, s in zip(best_x.tolist(), best_s.tolist(), strict=True)]
    return pa.table({
        "query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()),
        "score": pa.array([o[2] for o in out], pa.int64())})


def top_k(table: DataFrame, is_query: Column, k: int = 5, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with the other rows of ``table``.

    ``table`` is a ``pivot_table``; ``is_query`` picks the queries by its column ``id``. Each
    block of queries meets each block of the table in one task of bounded size; only k rows
    per query leave it and are merged. Ties go to the smaller id.

    Defined cases: vectors that are null or hold null or non-finite components, and null ids,
    take no part; only vectors of the same dimension meet; a query with fewer than k others
    gets them all; repeated ids are candidates each, never of a query with that id, and one query; without
    queries or rows the result is empty.
    """
    queries = table.filter(is_query).select("id", "v", "dim", "norm2", "dist", "block")
    sizes = queries.groupBy("dim").count()
    q_blocks = max(1, math.ceil((sizes.agg(F.max("count")).first()[0] or 0) / block_queries))
    blocks = (table.agg(F.max("block")).first()[0] or 0) + 1
    keys = ["dim", "block", "q_block"]
    data = table.join(F.broadcast(queries.select("dim").distinct()), "dim", "left_semi").withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    queries = queries.drop("block").toDF("id", "v", "dim", "norm2", "dist").withColumn("q_block", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(q_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(
        tidy_group(lambda a, b: best_of_block(a, b, k)), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
