"""Records whose quoted fields hold line breaks, read from files that still split.

A line either starts outside of quotes or inside a quoted field, and leaves the one or the other: a map of two states.
The maps of a split's lines compose to one map a split, and a scan over a file's splits gives the state each of them
starts in. Lines that start outside begin a record; the lines of a longer record are put together by its first line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage

# places in a line: at the start of a field, in a plain field, in a quoted one, after a quote in a quoted one
START, PLAIN, QUOTED, CLOSING = range(4)


def _ends_open(line: Column, place: int) -> Column:
    """Whether ``line``, begun at ``place``, ends in a quoted field. A quote opens only at the start of a field; doubled ones stay inside."""

    def past(at: Column, text: Column) -> Column:
        return F.when((at == QUOTED) | (text == ""), at).when(text.endswith("\t"), START).otherwise(PLAIN)

    def quote(at: Column) -> Column:
        return F.when(at == START, QUOTED).when(at == QUOTED, CLOSING).when(at == CLOSING, QUOTED).otherwise(PLAIN)

    # every piece but the first follows a quote
    pieces = F.split(line, '"', -1)
    first = past(F.lit(place), F.element_at(pieces, 1))
    return F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, lambda at, text: past(quote(at), text)) == QUOTED


def _state_before(first: Column, out: Column, into: Column, order: Window) -> Column:
    """The state that rows before this one lead to from ``first``; a row maps outside to ``out`` and inside to ``into``.

    That is the result of the last constant map, or ``first``, turned over by each exchange of the two states since.
    """
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum(F.when(out & ~into, 1).otherwise(0))
    since = F.last(F.when(out == into, F.struct(out.alias("open"), F.col("_turns").alias("turns"))), ignorenulls=True).over(before)
    turned = F.coalesce(turns.over(before), F.lit(0)) - F.coalesce(since["turns"], F.lit(0))
    return F.coalesce(since["open"], first) != (turned % 2 == 1)


def _with_turns(df: DataFrame, out: str, into: str, order: Window) -> DataFrame:
    turns = F.sum(F.when(F.col(out) & ~F.col(into), 1).otherwise(0))
    return df.withColumn("_turns", turns.over(order.rowsBetween(Window.unboundedPreceding, 0)))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(record, ord, header)``: the records of text files; ``ord`` is the position of the first line.

    ``header`` marks the first record of a file. Lines end at a line feed; a carriage return before a record's end is
    dropped, inside quotes it stays. Blank records are left out. A file that ends inside a quoted field fails the job.
    Every line is shuffled once, by split, and staged; only lines of records that go over several meet again.
    """
    line = F.col("value")
    marked = F.contains(line, F.lit('"'))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        line.alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (marked & _ends_open(line, START)).alias("out"),
        (~marked | _ends_open(line, QUOTED)).alias("into"),
    )
    order = Window.partitionBy("file", "block").orderBy("row")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    out, into = F.col("out"), F.col("into")
    # all that follows from a split alone, for either state it may start in (0 outside, 1 inside)
    lines = _with_turns(lines, "out", "into", order)
    lines = lines.withColumns({f"open{k}": _state_before(F.lit(bool(k)), out, into, order) for k in (0, 1)})
    lines = lines.withColumns({f"head{k}": F.last(F.when(~F.col(f"open{k}"), F.col("row")), ignorenulls=True).over(upto) for k in (0, 1)})
    first = F.min(F.when(~_blank("line"), F.col("row"))).over(Window.partitionBy("file", "block"))
    lines = stage(lines.withColumn("header", (F.col("block") == 0) & (F.col("row") == first)).drop("_turns"), "quoted-lines")

    def leads(k: int) -> Column:
        return F.when(F.col(f"open{k}"), into).otherwise(out)

    splits = lines.groupBy("file", "block").agg(
        F.max_by(leads(0), "row").alias("out"), F.max_by(leads(1), "row").alias("into"), F.max("head0").alias("head0"), F.max("head1").alias("head1")
    )

    def met(name: str) -> Column:
        return F.when(F.col("entry"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = lines.join(_entries(splits), ["file", "block"]).select(
        "line",
        "header",
        F.when(met("head").isNotNull(), F.struct("file", "block", met("head").alias("row"))).otherwise(F.col("carried")).alias("ord"),
        F.struct("block", "row").alias("at"),
        (met("open") | out).alias("long"),  # of more lines than one
    )
    parts = placed.where("long").groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("l"), F.max("header").alias("header"))
    longer = parts.select(F.array_join("l.line", "\n").alias("record"), "ord", "header")
    whole = placed.where("NOT long").select(F.col("line").alias("record"), "ord", "header").unionByName(longer)
    return whole.select(F.regexp_replace("record", "\r$", "").alias("record"), "ord", "header").where(~_blank("record"))


def _blank(line: str) -> Column:
    return F.trim(line, F.lit(" \r")) == ""


def _entries(splits: DataFrame) -> DataFrame:
    """``(file, block, entry, carried)``: whether a split starts inside quotes, and the first line of the record it starts in."""
    order = Window.partitionBy("file").orderBy("block")
    out, into = F.col("out"), F.col("into")
    known = _with_turns(splits, "out", "into", order).withColumn("entry", _state_before(F.lit(False), out, into, order))
    head = F.when(F.col("entry"), F.col("head1")).otherwise(F.col("head0"))
    last = F.when(head.isNotNull(), F.struct("file", "block", head.alias("row")))
    known = known.withColumn("carried", F.last(last, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    end = F.last(F.when(F.col("entry"), into).otherwise(out)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    fails = F.raise_error(F.concat(F.col("file"), F.lit(" ends inside a quoted field"))).cast("boolean")
    return known.withColumn("end", end).select("file", "block", F.when(F.col("end"), fails).otherwise(F.col("entry")).alias("entry"), "carried")

