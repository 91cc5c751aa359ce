"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector's components are cut into equal segments; each has a mean and a deviation. For two vectors
the squared distance is at least the sum over segments of length x ((difference of means)^2 +
(difference of deviations)^2), so their inner product is at most the sum of length x (product of
means + product of deviations). The bound tightens from coarse to fine segments; candidates that it
rules out at one level are not looked at in the next, and exact products are computed for the rest.

Queries and candidates meet block by block: a cell holds one block of either, so no task ever holds
more than two blocks, and each cell returns at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinmatch.llm.common import arrow_settings, stage

#: Rows of a block of candidates and of queries.
CANDIDATES = 4096
QUERIES = 8192
#: Segments of each level, coarse to fine; the last level is the components themselves.
LEVELS = (1, 4, 16)
_MOST = (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component x as a double. Vectors null, empty or holding null or not finite numbers are left out.

    Rows that repeat a vec_id, or a vec_id and its vector, are rows of their own; rows without a
    vec_id are left out. A component that does not fit 64 bits ends the job.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform("x", lambda c: F.when(F.abs(c) < float(1 << 62) / scale, F.floor(c * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("a component does not fit 64 bits"))))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
    return usable.where(whole).select("vec_id", v.alias("v"))


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations by segment, times the root of the segment's length: their products sum to the bound."""
    bounds = np.linspace(0, rows.shape[1], min(segments, rows.shape[1]) + 1).astype(int)
    lengths = np.diff(bounds)
    means = np.add.reduceat(rows, bounds[:-1], axis=1) / lengths
    squares = np.add.reduceat(rows * rows, bounds[:-1], axis=1) / lengths
    return np.hstack([means, np.sqrt(np.maximum(squares - means * means, 0))]) * np.sqrt(np.r_[lengths, lengths])


def search_cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best of ``rows`` for each query, ties to smaller ids; a query's own id is left out."""
    order = np.argsort(ids)
    ids, rows = ids[order], rows[order]
    if int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * rows.shape[1] > _MOST:
        rows, queries = rows.astype(object), queries.astype(object)  # Python's integers, where 64 bits might not do
    wide, wide_queries = rows.astype(np.float64), queries.astype(np.float64)
    sharp = [(segment_statistics(wide_queries, s), segment_statistics(wide, s)) for s in LEVELS]
    # rounding of the bounds: a few units in the last place of the largest possible product
    slack = 1e-9 * np.linalg.norm(wide_queries, axis=1) * np.linalg.norm(wide, axis=1).max(initial=0) + 1e-9
    coarse = sharp[0][0] @ sharp[0][1].T
    out = []
    for i, query_id in enumerate(query_ids.tolist()):
        bound = coarse[i]
        start = np.argpartition(-bound, k + 1)[: k + 1] if len(bound) > k + 1 else np.arange(len(bound))
        start = start[ids[start] != query_id]
        exact = rows[start] @ queries[i]
        least = float(np.sort(exact)[-k]) - slack[i] if len(exact) >= k else -np.inf
        alive = np.flatnonzero(bound + slack[i] >= least)
        for of_queries, of_rows in sharp[1:]:
            if len(alive) <= 4 * k:
                break
            alive = alive[of_rows[alive] @ of_queries[i] + slack[i] >= least]
        alive = alive[ids[alive] != query_id]
        exact = rows[alive] @ queries[i]
        best = np.argsort(-exact, kind="stable")[:k]  # ids ascend, so ties keep the smaller ones
        out += [(query_id, v, s) for v, s in zip(ids[alive[best]].tolist(), exact[best].tolist(), strict=True)]
    if any(abs(s) > _MOST for _, _, s in out):
        raise OverflowError("a score does not fit 64 bits")
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries``, both as ``quantised`` gives them.

    Score: integer inner product, ties to the smaller vec_id; a query never finds its own vec_id.
    Vectors of another length than the query's are no candidates. Fewer than k candidates: all.
    Rows that repeat a vec_id are candidates of their own; as queries their answers are ranked
    together. A score among the k best that does not fit 64 bits ends the job. ``vectors`` should be
    a staged table: its rows are numbered, so that repeated rows spread over all blocks.
    """
    arrow_settings(vectors.sparkSession)
    vectors = vectors.select("vec_id", "v", F.size("v").alias("length"))
    queries = queries.select("vec_id", "v", F.size("v").alias("length"))
    rows = max(1, -(-vectors.count() // CANDIDATES))
    columns = max(1, -(-queries.count() // QUERIES))
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    left = vectors.withColumn("row", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(rows))).withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))))
    right = queries.withColumn("col", spread(columns)).withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))))

    def cell(key: tuple, candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asked.num_rows:
            sides = [(t.column("vec_id").to_numpy(), np.array(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1)) for t in (asked, candidates)]
            found = search_cell(*sides[0], *sides[1], k)
        columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    met = left.groupBy("row", "col", "length").cogroup(right.groupBy("row", "col", "length"))
    best = stage(met.applyInArrow(cell, "query_id long, vec_id long, score long"), "cell-best")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
