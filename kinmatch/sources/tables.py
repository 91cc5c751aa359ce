"""Readers and writers of source tables and ID-list tables (tab-separated text).

One line is one record, so large files split over tasks. ``ord`` is the position of a row in its
files: (file, block, row), which sorts in file order without a numbering pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from . import quoted

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
LINK_COLUMNS = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_COLUMNS = ("source1_entity_id", "candidate_entity_ids")


def _strings(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _position() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("ord")


def _read(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], multiline: bool = False) -> DataFrame:
    raw = (
        spark.read.schema(_strings(columns))
        .option("sep", "\t")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", True)
        .csv(path)
    )
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns], _position())


def _read_quoted(spark: SparkSession, path: str | list[str], columns: tuple[str, ...]) -> DataFrame:
    records = quoted.read_records(spark, path).where("NOT header")
    fields = F.from_csv("record", ", ".join(f"{c} string" for c in columns), {"sep": "\t", "escape": '"', "multiLine": "true"})
    return records.select(fields.alias("r"), "ord").select(*[F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in columns], "ord")


def read_source(
    spark: SparkSession, path: str | list[str], nrows: int | None = None, multiline: bool = False, quoted_breaks: bool = False
) -> DataFrame:
    """A source table: all text, empties kept as empty text, optionally the first ``nrows`` rows.

    Both ``quoted_breaks`` and ``multiline`` allow line breaks inside quoted fields: the first splits files and
    shuffles their lines once, the second reads each file in one task.
    """
    table = _read_quoted(spark, path, SOURCE_COLUMNS) if quoted_breaks else _read(spark, path, SOURCE_COLUMNS, multiline)
    return table if nrows is None else table.orderBy("ord").limit(nrows)


def records(source: DataFrame) -> DataFrame:
    """The working frame of the pipeline: ``(entity_id, src, nn, na, cc, ord)``."""
    return source.select(
        "entity_id",
        F.substring(tx.source_of(F.col("entity_id")), 2, 9).cast("int").alias("src"),
        tx.normalize(F.col("business_name")).alias("nn"),
        tx.normalize(F.col("business_address")).alias("na"),
        tx.normalize_country(F.col("country")).alias("cc"),
        "ord",
    )


def candidates_by_country(s2: DataFrame, s3: DataFrame, country: str | None = None) -> DataFrame:
    """Sources 2 and 3 together; one normalised country, or all with ``cc`` as a key."""
    both = s2.unionByName(s3).withColumn("cc", tx.normalize_country(F.col("country")))
    return both if country is None else both.where(F.col("cc") == country)


def source_ids(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct IDs of the first column, trimmed; the header and blank lines are left out."""
    lines = read_lines(spark, path)
    body = split_header(lines)[1].where(~_blank(F.col("line")))
    first = F.substring_index("line", "\t", 1)
    return body.select(F.regexp_replace(first, f"^[{tx.SPACE}]+|[{tx.SPACE}]+$", "").alias("entity_id")).distinct()


# ---------------------------------------------------------------- ID lists


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{tx.SPACE}]+|[{tx.SPACE}]+$", "")


def id_set(raw: Column) -> Column:
    """The distinct non-empty IDs of a comma list, each trimmed."""
    return F.array_distinct(F.array_remove(F.transform(F.split(raw, ","), _trim), ""))


def read_links(spark: SparkSession, path: str | list[str], columns: tuple[str, str] = LINK_COLUMNS) -> DataFrame:
    """An ID-list table as written by :func:`write_links`."""
    return _read(spark, path, columns)


def ground_truth(links: DataFrame, order: str | None = None) -> DataFrame:
    """``(s1_id, truth)`` from a link table; of repeated source-1 rows the last one counts."""
    rows = links.withColumn("s1_id", _trim(F.col("source1_entity_id")))
    if order is not None:
        rows = rows.groupBy("s1_id").agg(F.max_by("matched_entity_ids", order).alias("matched_entity_ids"))
    return rows.select("s1_id", id_set(F.col("matched_entity_ids")).alias("truth"))


def ground_truth_of(truth: DataFrame, wanted: DataFrame) -> DataFrame:
    """Truth of the wanted ``s1_id`` rows only; an ID without a row has the empty set."""
    empty = F.array().cast("array<string>")
    return wanted.select("s1_id").join(truth, "s1_id", "left").select("s1_id", F.coalesce("truth", empty).alias("truth"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", F.explode("truth").alias("c_id"))


def explode_lists(lists: DataFrame, s1: DataFrame, column: str = "candidate_entity_ids") -> DataFrame:
    """Ordered pairs ``(s1_id, c_id, pos)`` of stored lists, for the given source-1 records only.

    With an ``ord`` column, the last of several rows for one record counts.
    """
    ids = F.array_remove(F.split(_trim(F.col(column)), ","), "")
    wanted = s1.select(F.col("entity_id").alias("source1_entity_id"))
    if "ord" in lists.columns:
        lists = lists.groupBy("source1_entity_id").agg(F.max_by(column, "ord").alias(column))
    return (
        lists.join(wanted, "source1_entity_id", "left_semi")
        .select(F.col("source1_entity_id").alias("s1_id"), F.posexplode(ids).alias("pos", "c_id"))
        .select("s1_id", "c_id", (F.col("pos") + 1).alias("pos"))
    )


def id_lists(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row per source-1 record: its IDs in list order joined by commas, empty when none."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("pos", "c_id"))).alias("l"))
    return (
        s1.select(F.col("entity_id").alias("s1_id"), "ord")
        .join(lists, "s1_id", "left")
        .select(
            F.col("s1_id").alias("source1_entity_id"),
            F.coalesce(F.array_join(F.transform("l", lambda x: x["c_id"]), ","), F.lit("")).alias(column),
            "ord",
        )
    )


def link_lists(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    return id_lists(s1, pairs, "matched_entity_ids")


def candidate_lists(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    return id_lists(s1, pairs, "candidate_entity_ids")


def write_tsv(table: DataFrame, path: str, order: str | None = None) -> None:
    """Tab-separated text with a header. With ``order`` the part files follow it globally."""
    rows = table if order is None else table.orderBy(order).drop(order)
    (
        rows.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def write_links(lists: DataFrame, path: str) -> None:
    """ID lists in source-1 order, nothing quoted."""
    rows = lists.orderBy("ord").drop("ord")
    (
        rows.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )


def write_parts(lists: DataFrame, path: str) -> None:
    """Part sink: one directory per country and row range; only the parts at hand are replaced."""
    (
        lists.repartition("cc", "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("cc", "part")
        .parquet(path)
    )


def merge_parts(s1: DataFrame, parts: DataFrame, column: str = "matched_entity_ids", missing: Observation | None = None) -> DataFrame:
    """Union of part rows ``(source1_entity_id, <column>, part_id)`` in source-1 order.

    Of several rows for one record that of the last part counts; a record without one gets an
    empty list and ``found`` = 0. ``missing`` holds their number as ``n_missing``, and that of empty lists as
    ``n_empty``, once the result was written or otherwise used in whole.
    """
    last = parts.groupBy("source1_entity_id").agg(F.max_by(column, "part_id").alias(column))
    merged = (
        s1.select(F.col("entity_id").alias("source1_entity_id"), "ord")
        .join(last, "source1_entity_id", "left")
        .select(
            "source1_entity_id",
            F.coalesce(column, F.lit("")).alias(column),
            F.col(column).isNotNull().cast("int").alias("found"),
            "ord",
        )
    )
    if missing is None:
        return merged
    return merged.observe(missing, F.count_if(F.col("found") == 0).alias("n_missing"), F.count_if(F.col(column) == "").alias("n_empty"))


def missing_parts(merged: DataFrame) -> DataFrame:
    return merged.where("found = 0").select("source1_entity_id")


def merge_complete(s1: DataFrame, parts: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """As :func:`merge_parts`, but the number of collected records must equal that of source 1."""
    n_s1 = s1.count()
    n_got = parts.select("source1_entity_id").distinct().count()
    if n_got != n_s1:
        raise ValueError(f"parts hold {n_got} source-1 records, the source table {n_s1}")
    return merge_parts(s1, parts, column).drop("found")


# ---------------------------------------------------------------- raw lines


def _blank(line: Column) -> Column:
    return _trim(line) == ""


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files with their position: ``(line, ord)``."""
    return spark.read.text(path).select(F.col("value").alias("line"), _position())


def _headers(lines: DataFrame) -> DataFrame:
    """The first line of each file; only first blocks are looked at."""
    first = Window.partitionBy("ord.file").orderBy("ord")
    return (
        lines.where(F.col("ord.block") == 0)
        .withColumn("_at", F.row_number().over(first))
        .where(F.col("_at") == 1)
        .drop("_at")
    )


def split_header(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(header lines, other lines)`` of :func:`read_lines` output."""
    headers = _headers(lines)
    return headers, _without(lines, headers)


def _without(lines: DataFrame, headers: DataFrame) -> DataFrame:
    # one row per input file: no larger than the file listing the driver already holds
    return lines.join(F.broadcast(headers.select("ord")), "ord", "left_anti")
