"""The corpus pipeline: quality, exact duplicates, near duplicates, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import exact_dedup, mixing, quality, sentencepieces, simhash
from kinmatch.llm.common import stage, table
from kinmatch.session import delete, scratch, scratch_path

#: Documents with a smaller score for good quality are rejected.
REJECT_BELOW = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores below ``REJECT_BELOW``; learns from the labelled rows that are not held out.

    Null text is empty and is scored like any other; rows are told apart by their place, so repeated and null doc_ids do no harm.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~quality.held_out())
    with scratch(spark):
        model = quality.train(docs, labels)
    columns, docs = docs.columns, exact_dedup.located(docs)
    keyed = docs.select(F.col("_at").alias("doc_id"), "text")
    rejected = stage(quality.score(keyed, model).where(F.col("score") < REJECT_BELOW).select(F.col("doc_id").alias("_at")), "rejected")
    return docs.join(rejected.hint("merge"), "_at", "left_anti").select(*columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts equal up to white space stay once, with the smallest doc_id; null text is empty and null doc_ids come last."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies differ in at most 2 bits of their SimHash over 3-word shingles; of each group that links reach, the smallest doc_id stays."""
    return simhash.without_near_copies(docs, words=3, threshold=2)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages to the square roots of their shares; the labelled rows name the language. Null text has no tokens; rows with a null doc_id are drawn alike."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")
    return mixing.mixed(docs, labelled)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text and their number."""
    encoded = sentencepieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("encoding", encode),
]

#: Scores, fingerprints, fits and subword ids can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again, and go when the next one's are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        path = scratch_path(spark, f"stage/pipeline-{name}")
        with scratch(spark):
            docs = stage(function(spark, docs, sf_dir), name, path)
        if before:
            delete(spark, before)
        before = path
    return docs
