"""Centroid clustering of integer vectors; each vector finds its nearest centroid by Orchard's search.

For every centroid the others are listed by their distance to it. A vector starts at some centroid
and reads that centroid's list; when a closer centroid turns up it goes on with that one's list.
Centroids are marked when visited and looked at once. The search stops at the first entry that is
strictly further from the present centroid than twice the vector's distance: by the triangle
inequality neither it nor anything behind it can be as near. All arithmetic is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import arrow_settings, stage

#: Components below this give squared distances, and four times these, within 64 bits at up to 1024 components.
NARROW = 1 << 25
_MOST = (1 << 63) - 1


def usable(vectors: DataFrame, size: int) -> DataFrame:
    """(vec_id, x): vectors of exactly ``size`` components, as doubles, none null, NaN or infinite."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    return slim.where("x IS NOT NULL").where(F.size("x") == size).where(whole)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python's where these don't hold the squares. ``scale`` is a power of two, so products are exact."""
    if np.abs(x).max(initial=0) * scale < NARROW and x.shape[-1] <= 1024:
        return np.floor(x * scale).astype(np.int64)
    exact = [math.floor(v * scale) if abs(v) < 2**52 else int(v) * scale for v in x.ravel().tolist()]
    return np.array([*exact, None], object)[:-1].reshape(x.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


class Orchard:
    """Nearest of ``centroids`` (rows of Python or 64-bit integers), ties to the smaller number."""

    def __init__(self, centroids: list[list[int]]) -> None:
        most = max((abs(v) for c in centroids for v in c), default=0)
        self.narrow = most < NARROW
        self.centroids = np.array(centroids, np.int64 if self.narrow else object)
        self.between = np.array([squared(self.centroids, c) for c in self.centroids])
        # each centroid's list starts behind itself
        number = np.arange(len(centroids))
        self.lists = np.array([[k for k in sorted(number.tolist(), key=lambda k: (row[k], k)) if k != c] for c, row in enumerate(self.between)], np.int64)
        sums = self.centroids.sum(axis=1)
        self.by_sum = np.array(sorted(number.tolist(), key=lambda k: sums[k]))
        self.sums = sums[self.by_sum]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid, and the number of distances computed."""
        n, k = len(rows), len(self.centroids)
        centroids, between = self.centroids, self.between
        if rows.dtype != centroids.dtype:
            rows, centroids, between = (x.astype(object) for x in (rows, centroids, between))
        # any start gives the same answer; a centroid of about the same sum is rarely far
        near = np.searchsorted(self.sums.astype(np.float64), rows.sum(axis=1).astype(np.float64))
        at = self.by_sum[np.minimum(near, k - 1)]
        best = squared(rows, centroids[at])
        visited = np.zeros((n, k), bool)
        visited[np.arange(n), at] = True
        place, active, looked = np.zeros(n, np.int64), np.arange(n), n
        while len(active := active[place[active] < k - 1]):
            other = self.lists[at[active], place[active]]
            go = (between[at[active], other] <= 4 * best[active]).astype(bool)
            active, other = active[go], other[go]
            place[active] += 1
            new = ~visited[active, other]
            seen, to = active[new], other[new]
            visited[seen, to] = True
            looked += len(seen)
            d = squared(rows[seen], centroids[to])
            closer = ((d < best[seen]) | ((d == best[seen]) & (to < at[seen]))).astype(bool)
            jump = seen[closer]
            at[jump], best[jump], place[jump] = to[closer], d[closer], 0
        return at, best, looked


def _rows(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    return integers(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), scale)


def _sums(orchard: Orchard, scale: int, size: int):
    """One row a centroid and task: number of its vectors and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch, scale)
            at, _, _ = orchard.nearest(rows)
            for k in np.unique(at).tolist():
                own = rows[at == k]
                held = totals.setdefault(k, [0, [0] * size])
                held[0] += len(own)
                held[1] = [a + int(b) for a, b in zip(held[1], own.sum(axis=0).tolist(), strict=True)]
        if totals:
            columns = [[*totals], [n for n, _ in totals.values()], [[Decimal(v) for v in s] for _, s in totals.values()]]
            types = [pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["cluster", "n", "s"])

    return run


def _assigned(orchard: Orchard, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, best, _ = orchard.nearest(_rows(batch, scale))
            if max(best.tolist()) > _MOST:
                raise OverflowError("a squared distance does not fit 64 bits")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32()), pa.array(best.tolist(), pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable row of ``vectors`` (vec_id, embedding, ...).

    Usable vectors have exactly ``size`` components, none null or not finite; components become
    floor(scale * x). Centroids start as the ``k`` vectors with the smallest SHA-256 of
    ``seed:vec_id`` (all, if fewer; a null vec_id is hashed as ''; vectors that repeat a vec_id go by
    their components). Each round assigns every vector to its nearest centroid, ties to the smaller
    number, and replaces each centroid that has vectors by the floor of their mean; then vectors are
    assigned once more. Repeated rows count and come back as often as they occur; extra columns are
    ignored; an empty table gives an empty result. A distance beyond 64 bits ends the job.

    The driver holds the centroids and, a round, one sum for each: bounded by ``k`` and ``size``.
    """
    spark = vectors.sparkSession
    arrow_settings(spark)
    slim = usable(vectors, size)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = slim.select(digest.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    out = "vec_id long, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [[int(v) for v in integers(np.array(r.x), scale).tolist()] for r in first]
    for _ in range(rounds):
        parts = slim.mapInArrow(_sums(Orchard(centroids), scale, size), "cluster int, n long, s array<decimal(38,0)>")
        sums = parts.select("cluster", "n", F.posexplode("s").alias("at", "v")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        for r in sums.collect():
            centroids[r.cluster][r.at] = int(r.v) // r.n
    found = stage(slim.mapInArrow(_assigned(Orchard(centroids), scale), out), "assigned")
    named = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = {r.cluster: r.cluster_inertia for r in inertia.collect()}
    rows = [(c, inertia[c], sum(inertia.values()), name) for c, name in named if c in inertia]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows at most
