"""First-n and row-range selection per group without sorting a whole group in one task.

A plain ``row_number`` over a large group puts that group into one task. Here every group is
counted by a coarse key first; only the coarse bucket in which the cut falls is sorted. The per
group figures are staged, so the engine knows how small they are and the rows themselves are not
shuffled by group to meet them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def spread(entity_id: str | Column) -> Column:
    """A repeatable pseudo-random order of IDs, the same in any engine with MD5."""
    return F.md5(F.col(entity_id) if isinstance(entity_id, str) else entity_id)


def spread_bucket(digest: Column) -> Column:
    """65,536 even buckets, in the order of the digest."""
    return F.substring(digest, 1, 4)


def bucket_starts(df: DataFrame, group: list[str], coarse: str) -> DataFrame:
    """Rows of the group that lie in earlier coarse buckets: one row per (group, bucket)."""
    counts = df.groupBy(*group, coarse).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))


def first_n(df: DataFrame, group: list[str], coarse: list[str], fine: list[Column], n: Column) -> DataFrame:
    """The first ``n`` rows of each group in the order (coarse..., fine...).

    ``n`` is an expression over the group columns. ``coarse`` columns are narrowed one after the
    other, each inside the bucket left open by the one before. Without a group the whole frame is
    one; its cut is a single staged row, so meeting it shuffles nothing.
    """
    pending = df.withColumn("_n", n.cast("long"))
    kept = df.columns
    if not group:
        group = ["_all"]
        pending = pending.withColumn("_all", F.lit(0))
    sure: DataFrame | None = None
    for column in coarse:
        starts = bucket_starts(pending, [*group, "_n"], column)
        cut = (
            starts.where((F.col("_before") < F.col("_n")) & (F.col("_before") + F.col("_rows") >= F.col("_n")))
            .select(*group, F.col(column).alias("_cut"), (F.col("_n") - F.col("_before")).alias("_left"))
        )
        cut = stage(cut, "cut")
        placed = pending.join(cut, group, "left")
        inside = placed.where(
            (F.col("_n") > 0) & (F.col("_cut").isNull() | (F.col(column) < F.col("_cut")))
        ).select(*kept)
        sure = inside if sure is None else sure.unionByName(inside)
        pending = placed.where(F.col(column) == F.col("_cut")).select(
            *dict.fromkeys([*kept, *group]), F.col("_left").alias("_n")
        )
    last = pending.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, *coarse).orderBy(*fine)))
    tail = last.where(F.col("_rank") <= F.col("_n")).select(*kept)
    return sure.unionByName(tail)


def ordinal(df: DataFrame, group: list[str], coarse: str, fine: list[Column], name: str) -> DataFrame:
    """Add the zero-based position of each row inside its group."""
    starts = stage(bucket_starts(df, group, coarse).drop("_rows"), "starts")
    inside = F.row_number().over(Window.partitionBy(*group, coarse).orderBy(*fine)) - 1
    return (
        df.withColumn("_inside", inside)
        .join(starts, [*group, coarse])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )


def row_range(df: DataFrame, group: list[str], coarse: str, fine: list[Column], start: int, end: int) -> DataFrame:
    """Rows ``start`` up to but not including ``end`` of each group.

    Buckets that lie wholly outside the range are dropped before any sorting.
    """
    starts = bucket_starts(df, group, coarse).where(
        (F.col("_before") < end) & (F.col("_before") + F.col("_rows") > start)
    )
    inside = F.row_number().over(Window.partitionBy(*group, coarse).orderBy(*fine)) - 1
    starts = stage(starts.drop("_rows"), "starts")
    return (
        df.join(starts, [*group, coarse])
        .withColumn("_at", F.col("_before") + inside)
        .where((F.col("_at") >= start) & (F.col("_at") < end))
        .drop("_before", "_at")
    )
