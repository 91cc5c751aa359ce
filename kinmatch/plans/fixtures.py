"""Linkage tables derived from the test tables: a catalogue (with truth) and documents.

Each builder has a twin in :mod:`kinmatch.plans.sql`. Every row of the given table is used: a part
is always in source 1, and sources 2 and 3 carry it according to its type; a document is in the
source its ID falls in, with its first six words as name and all the others as address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

SCHEMA = ("entity_id", "src", "business_name", "business_address", "country", "ord")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(table: DataFrame, key: str) -> DataFrame:
    """Rows of a table that is short in bytes for the work a row takes: a file of some megabytes would be read, and all its texts normalised, in one task."""
    return table.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def catalog_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of all three sources made from ``part``."""
    k = F.col("p_partkey")
    core = F.concat_ws(
        " ", "p_name", F.replace(F.lower("p_brand"), F.lit("#"), F.lit(" ")), (k % 211).cast("string")
    )
    table = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    parts = _dealt(table, "p_partkey").select(
        k.alias("k"),
        "p_type",
        core.alias("core"),
        F.concat_ws(" ", F.col("p_size").cast("string"), F.lower("p_type"), (k % 503).cast("string")).alias("stub"),
        F.when(k % 20 < 9, "US").when(k % 20 < 17, "India").otherwise("France").alias("country"),
    )
    kind = (F.col("k") % 4 + 1).cast("int")
    form1 = F.element_at(F.array(*map(F.lit, ["Corporation", "Private Limited", "& Company", "Incorporated"])), kind)
    form2 = F.element_at(F.array(*map(F.lit, ["Corp.", "Pvt. Ltd.", "and Co", "Inc"])), kind)
    word = F.split("core", " ")
    swapped = F.concat_ws(" ", word[1], word[0], word[2], word[3], F.lit("trading"))

    def record(src: int, name, address):
        return F.struct(F.lit(src).alias("src"), name.alias("business_name"), address.alias("business_address"))

    first = record(1, F.concat_ws(" ", "core", form1), F.concat("stub", F.lit(" Road")))
    second = record(2, F.concat_ws(" ", F.upper("core"), form2), F.concat("stub", F.lit(" Rd.")))
    third = record(3, swapped, F.when(F.col("p_type") == "LARGE", "").otherwise(F.col("stub")))
    listed = (
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), F.array(first, second, third))
        .when(F.col("p_type") == "PROMO", F.array(first))
        .otherwise(F.array(first, second))
    )
    return parts.select("k", "country", F.explode(listed).alias("r")).select(
        F.format_string("S%d-%d", "r.src", "k").alias("entity_id"),
        "r.src",
        "r.business_name",
        "r.business_address",
        "country",
        F.col("k").alias("ord"),
    )


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records made from ``documents``: multilingual, with exact and near copies."""
    word = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    src = (F.col("doc_id") % 3 + 1).cast("int")
    return _table(spark, sf_dir, "documents").select(
        F.format_string("S%d-%d", src, "doc_id").alias("entity_id"),
        src.alias("src"),
        F.array_join(F.slice(word, 1, 6), " ").alias("business_name"),
        F.array_join(F.slice(word, F.lit(7), F.greatest(F.size(word), F.lit(0))), " ").alias("business_address"),
        F.col("lang").alias("country"),
        F.col("doc_id").alias("ord"),
    )


def normalized(raw: DataFrame) -> DataFrame:
    """``records`` frame of raw source rows."""
    return raw.select(
        "entity_id",
        "src",
        tx.normalize(F.col("business_name")).alias("nn"),
        tx.normalize(F.col("business_address")).alias("na"),
        tx.normalize_country(F.col("country")).alias("cc"),
        "ord",
    )


def split_sources(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return records.where("src = 1"), records.where("src in (2, 3)")


def catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_sources(normalized(catalog_sources(spark, sf_dir)))


def document_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_sources(normalized(document_sources(spark, sf_dir)))


def catalog_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth as a link table ``(source1_entity_id, matched_entity_ids)``, untidy on purpose."""
    k = F.col("p_partkey").cast("string")
    s2 = F.concat(F.lit("S2-"), k)
    s3 = F.concat(F.lit("S3-"), k)
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("S1-"), k).alias("source1_entity_id"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), F.concat(s2, F.lit(" , "), s3, F.lit(",")))
        .when(F.col("p_type") == "PROMO", " ")
        .otherwise(F.concat(F.lit(" "), s2))
        .alias("matched_entity_ids"),
    )


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a link file made from ``part``, with one kind of fault per part size."""
    k = F.col("p_partkey").cast("string")
    tab = F.lit("\t")
    s1, s2, s3 = (F.concat(F.lit(f"S{n}-"), k) for n in (1, 2, 3))
    none = F.concat(s1, tab)
    lines = {
        1: [F.concat(s1, tab, s2, F.lit(","), s2)],
        2: [F.concat(s1, tab, s1, F.lit(","), s2)],
        3: [F.concat(s1, tab, F.lit("X9-"), k)],
        4: [F.concat(s1, tab, s2, F.lit(",,"), s3)],
        5: [F.concat(s1, tab, s2, F.lit("0000000"))],
        6: [],
        7: [none, F.concat(s1, tab, s2)],
        8: [none, F.concat(s1, F.lit("0000000"), tab)],
        9: [none, F.concat(s1, F.lit(" "), s2)],
        10: [none, F.lit("   ")],
    }
    usual = F.concat(s1, tab, F.when(F.col("p_type") == "PROMO", "").otherwise(s2))
    chosen = F.when(F.lit(False), F.array(usual))
    for size, faulty in lines.items():
        chosen = chosen.when(F.col("p_size") == size, F.array(*faulty).cast("array<string>"))
    chosen = chosen.otherwise(F.array(usual))
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), F.posexplode(chosen).alias("at", "line")
    ).select("line", F.struct("k", "at").alias("ord"))
