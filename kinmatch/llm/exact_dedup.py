"""Exact deduplication as a streaming job with disk-backed keyed state that never expires.

Arrivals carry a digest, a stable identifier and a content locator. A streaming aggregation keyed by
digest keeps, per digest, the smallest (identifier, locator) and the number of arrivals in a RocksDB
state store; without a watermark nothing is ever forgotten, so a later run over more files with the
same checkpoint goes on where the last one ended. The state is then read as a table. Every row whose
digest was met before is checked byte by byte against the text at the kept locator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import split_by, stage, text_or_empty, without
from kinmatch.session import scratch_path, settled

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # one memory bound for all stores of an executor
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no disk space is set aside ahead of need
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_at``: file and row number of each row. Rows that do not come straight from files are staged first."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select("*", place.alias("_at"))
    except AnalysisException:
        return stage(docs, "content").select("*", place.alias("_at"))


def _state_of(arrivals: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """(digest, first, n) after all files of ``folder`` went through the keyed state at ``checkpoint``."""
    spark = arrivals.sparkSession
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        keyed = (
            spark.readStream.schema(arrivals.schema).parquet(folder)
            .groupBy("digest").agg(F.min("arrival").alias("first"), F.count("*").alias("n"))
        )
        query = (
            keyed.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    state = spark.read.format("statestore").load(checkpoint).select("key.digest", "value.*")
    return state.toDF("digest", "first", "n")


def exact_duplicates(docs: DataFrame, digest_of: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest, _at) of every row of ``docs`` (doc_id, text, ...).

    Texts are equal when equal after ``normalised``. Of equal texts the row with the smallest doc_id
    stays; rows that repeat a doc_id and its text stay once, at the smallest file and row number.
    Null doc_ids count in ``group_size`` and come last: such a row stays only if its group has no
    other. Null text is the empty text, and empty texts equal each other. Extra columns are ignored;
    an empty table gives an empty result. Texts that share a digest but not their bytes are told
    apart by grouping those few on the text itself.

    ``docs`` should come from ``located``; else it is located here.
    """
    docs = docs if "_at" in docs.columns else located(docs)
    spark = docs.sparkSession
    text = normalised("text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), "_at")
    arrival = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_at")
    folder = scratch_path(spark, "stage/arrivals")
    slim.select(digest_of(F.col("text")).alias("digest"), arrival.alias("arrival")).write.parquet(folder)
    arrivals = spark.read.parquet(folder)
    if arrivals.isEmpty():
        return _rows(arrivals.select("digest", "arrival", F.col("arrival").alias("first"), F.lit(1).cast("long").alias("n")))
    held = stage(_state_of(arrivals, folder, scratch_path(spark, "dedup-state/run")), "held")

    placed = stage(arrivals.join(held, "digest"), "placed")
    met_again = placed.where("n > 1").select("digest", "arrival", "first", F.col("arrival._at").alias("_at"))
    # of texts, little more than those to be compared move
    maybe, _ = split_by(docs.select("text", "_at"), met_again.select("_at"), "_at")
    hits = stage(maybe.join(met_again, "_at").select("digest", "arrival", "first", text.alias("text")), "hits")
    kept = hits.where("arrival = first").select("digest", F.col("text").alias("kept_text"))
    # staged before it is made distinct, so that a hot digest's comparisons may be split over tasks
    other = stage(hits.where("arrival <> first").join(kept, "digest").where("text <> kept_text").select("digest"), "digest-clashes")
    if other.isEmpty():
        return _rows(placed)
    other = other.distinct()
    clashing = hits.join(other, "digest", "left_semi")
    own = clashing.groupBy("digest", "text").agg(F.min("arrival").alias("first"), F.count("*").alias("n"))
    told_apart = clashing.drop("first").join(own, ["digest", "text"]).select("digest", "arrival", "first", "n")
    plain = placed.join(other, "digest", "left_anti").select("digest", "arrival", "first", "n")
    return _rows(plain.unionByName(told_apart))


def _rows(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("arrival.doc_id").alias("doc_id"),
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("arrival") == F.col("first")).alias("kept"),
        "digest",
        F.col("arrival._at").alias("_at"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    columns, docs = docs.columns, located(docs)
    gone = settled(docs.sparkSession, "dropped", lambda: exact_duplicates(docs).where("NOT kept").select("_at"))
    return without(docs, gone, "_at").select(*columns)
