"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.session import stage

__all__ = ["arrow_settings", "components", "in_batches", "per_batch", "rows_in_order", "split_by", "stage", "table", "text_or_empty", "without"]

#: Rows and bytes of one Arrow batch, so that a batch of very long texts stays small in the Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def arrow_settings(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def per_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply ``function`` to each Arrow batch of ``df``."""
    arrow_settings(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def rows_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of a partition one by one, in order; only one batch is held."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def in_batches(rows: Iterable[tuple], fields: list[tuple[str, pa.DataType]], size: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    names, rows = [name for name, _ in fields], iter(rows)
    while held := list(islice(rows, size)):
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names)


#: A sketch has at least one block of bits and at most this many: 4 KiB each, 16 MiB in all.
BLOCK_BITS = 1 << 15
MOST_BLOCKS = 1 << 12


def split_by(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose ``key`` may be in ``keys``, and those whose key is surely not; nothing is shuffled.

    The keys are hashed into a bitmap of 32 to 64 bits a key, at most 16 MiB however many they are, which is
    broadcast. Its misses are certain, its hits are not: the first part still has to be joined with ``keys``. More
    than some ten million keys fill the bitmap, and then more and more rows are in the first part; the answer
    of that join stays the same. A null key is hashed like any other. ``keys`` is read twice, so it should be staged.
    """
    wanted = max(1, -(-keys.count() * 32 // BLOCK_BITS))
    blocks = min(MOST_BLOCKS, 1 << (wanted - 1).bit_length())
    place = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(blocks * BLOCK_BITS))
    hashed = keys.select(place.alias("p")).select(F.expr(f"int(p div {BLOCK_BITS})").alias("_block"), F.expr(f"int(p % {BLOCK_BITS})").alias("b"))
    bitmap = hashed.groupBy("_block").agg(F.bitmap_construct_agg("b").alias("_bits"))
    bitmap = F.broadcast(stage(bitmap, "sketch"))  # at most MOST_BLOCKS rows of 4 KiB
    asked = rows.withColumn("_p", place).withColumn("_block", F.expr(f"int(_p div {BLOCK_BITS})")).join(bitmap, "_block", "left")
    byte = F.expr(f"int(conv(hex(substring(_bits, 1 + int((_p % {BLOCK_BITS}) div 8), 1)), 16, 10))")
    maybe = F.coalesce(F.expr("_byte >> int(_p % 8)").bitwiseAND(1) == 1, F.lit(False))
    told = asked.withColumn("_byte", byte).withColumn("_maybe", maybe)
    return told.where("_maybe").select(*rows.columns), told.where("NOT _maybe").select(*rows.columns)


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in ``keys``, a staged table; only rows that may be in it are shuffled."""
    maybe, surely_not = split_by(rows, keys, key)
    return surely_not.unionByName(maybe.join(keys.hint("merge"), key, "left_anti"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps. Every round is two aggregations and two look-up
    joins over the edges and ends in a staged table, so the lineage stays short and a lost executor
    repeats one round; nothing but one count and one checksum reaches the driver. A hub only meets
    its neighbours one row each, which adaptive skew handling can split.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stage(small, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
