"""Vocabulary, IDF and TF-IDF vectors, fitted on the candidate side of each corpus.

Input frames are ``docs(corpus, id, text)``. A corpus is one field of one country, so both
streams of all countries go through the same jobs. Copies of a text are folded into one row
before tokenising, so a text that fills a third of a source is tokenised once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..params import LinkParams
from ..session import stage
from .ranking import first_n, spread, spread_bucket


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def fit_sample(docs: DataFrame, n: int, group: str = "corpus", key: str = "id") -> DataFrame:
    """At most ``n`` documents per group, without replacement, repeatable."""
    bucketed = docs.withColumn("_bucket", spread_bucket(spread(key)))
    return first_n(bucketed, [group], ["_bucket"], [spread(key), F.col(key)], F.lit(n)).drop("_bucket")


def _flag_fit(docs: DataFrame, n: int | None) -> DataFrame:
    """Mark the documents the fit may see: all without ``n``, else at most ``n`` of a corpus."""
    if n is None:
        return docs.withColumn("in_fit", F.lit(1))
    largest = docs.groupBy("corpus").count().agg(F.max("count")).first()[0] or 0
    if largest <= n:
        return docs.withColumn("in_fit", F.lit(1))
    chosen = fit_sample(docs.select("corpus", "id"), n).withColumn("in_fit", F.lit(1))
    return docs.join(chosen, ["corpus", "id"], "left").fillna(0, ["in_fit"])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per distinct text of a corpus: ``(corpus, dg, text, tkey, n_fit)``."""
    return (
        docs.withColumn("dg", digest(F.col("text")))
        .groupBy("corpus", "dg")
        .agg(F.first("text").alias("text"), F.min("id").alias("tkey"), F.sum("in_fit").alias("n_fit"))
    )


def term_counts(texts: DataFrame, analyzer: str, key: list[str], carry: list[str]) -> DataFrame:
    """Term frequency per text. ``key`` is what ``texts`` is hashed on, so nothing moves here."""
    return (
        tx.explode_terms(texts, [*key, *carry], "text", analyzer)
        .groupBy(*key, *carry, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def vocabulary(counts: DataFrame, corpus_sizes: DataFrame, params: LinkParams) -> DataFrame:
    """Terms inside the document-frequency limits: all, or the most frequent ``max_features`` of a corpus.

    Ties in frequency fall in the repeatable order of :func:`spread`.
    """
    found = eligible_terms(counts, corpus_sizes, params)
    return found if params.max_features is None else most_frequent(found, params.max_features)


def eligible_terms(counts: DataFrame, corpus_sizes: DataFrame, params: LinkParams) -> DataFrame:
    """Terms inside the document-frequency limits. A corpus too small for them has none."""
    return frequent_terms(counts, corpus_sizes, params).where(~F.col("heavy")).drop("heavy")


def frequent_terms(counts: DataFrame, corpus_sizes: DataFrame, params: LinkParams) -> DataFrame:
    """Terms of at least ``min_df`` documents; ``heavy`` are those above the upper limit.

    Each task adds up its own terms before anything moves, so a term of every document is one row a
    task. Heavy terms are in more than ``max_df`` of a corpus, so it has at most 1 / ``max_df`` times
    as many as a document has terms on average.
    """
    frequencies = (
        counts.where(F.col("n_fit") > 0)
        .groupBy("corpus", "term")
        .agg(F.sum("n_fit").alias("df"), F.sum(F.col("n_fit") * F.col("tf")).alias("total"))
        .where(F.col("df") >= params.min_df)
    )
    upper = F.lit(params.max_df) * F.col("n")
    return frequencies.join(corpus_sizes, "corpus").where(upper >= params.min_df).withColumn("heavy", F.col("df") > upper)


def most_frequent(found: DataFrame, n: int) -> DataFrame:
    keyed = found.withColumn("_down", -F.col("total")).withColumn("_bucket", spread_bucket(spread("term")))
    return first_n(
        keyed, ["corpus"], ["_down", "_bucket"], [spread("term"), F.col("term")], F.lit(n)
    ).drop("_down", "_bucket")


def idf(n: Column, df: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


#: Heavy terms that are sent to every task; more than that are not taken out ahead.
MOST_HEAVY = 100_000


class TermSpace:
    """Fitted vocabulary plus the staged term counts of the candidate texts.

    The vocabulary is written by ``keep``, so that it may outlive the counts.
    """

    def __init__(self, docs: DataFrame, params: LinkParams, keep: Callable[[DataFrame, str], DataFrame] = stage):
        self.params = params
        flagged = _flag_fit(docs, params.fit_sample)
        sizes = flagged.groupBy("corpus").agg(F.sum("in_fit").alias("n"))
        texts = distinct_texts(flagged)
        self.counts = stage(
            term_counts(texts, params.analyzer, ["corpus", "dg"], ["tkey", "n_fit"]).drop("dg"), "terms"
        )
        found = self._numbered(frequent_terms(self.counts, sizes, params), keep)
        self.vocab = found.where(~F.col("heavy")).drop("heavy")
        self.heavy = found.where("heavy").select("corpus", "term")
        self.few_heavy = 0 < self.heavy.count() <= MOST_HEAVY
        # a table within the limit as a whole needs no count per corpus
        if params.max_features is not None and self.vocab.count() > params.max_features:
            largest = self.vocab.groupBy("corpus").count().agg(F.max("count")).first()[0]
            if largest > params.max_features:
                self.vocab = keep(most_frequent(self.vocab, params.max_features), "vocab")

    @staticmethod
    def _numbered(found: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Add the IDF and a number per term; written at once, so the numbers stay."""
        return keep(
            found.select(
                "corpus",
                "term",
                "df",
                "total",
                idf(F.col("n"), F.col("df")).alias("idf"),
                F.monotonically_increasing_id().alias("tid"),
                "heavy",
            ),
            "vocab",
        )

    def without_heavy(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the terms above the upper document-frequency limit, dropped where they lie."""
        return counts.join(F.broadcast(self.heavy), ["corpus", "term"], "left_anti") if self.few_heavy else counts

    def weigh(self, counts: DataFrame, key: list[str]) -> DataFrame:
        """L2-normalised vectors ``(key..., vec)``, terms in the order (df, term).

        The vocabulary is a small staged table: the engine broadcasts it when its file size
        allows and joins by shuffle when it does not. Terms too common for the vocabulary, whose rows
        would meet in one task each, are dropped before. The sum of squares runs over the ordered
        array, so equal texts get bit-equal weights.
        """
        raw = self.without_heavy(counts).join(self.vocab, ["corpus", "term"]).groupBy(*key).agg(
            F.array_sort(
                F.collect_list(F.struct("df", "term", "tid", (F.col("tf") * F.col("idf")).alias("x")))
            ).alias("raw")
        )
        squares = F.aggregate("raw", F.lit(0.0), lambda acc, t: acc + t["x"] * t["x"])

        def over(norm: Column) -> Column:
            return F.transform(
                "raw",
                lambda t: F.struct(
                    t["tid"].alias("tid"), (t["x"] / norm).alias("w"), t["df"].alias("df"), t["term"].alias("term")
                ),
            )

        # the norm is bound as the element of a one-element array: worked out once, not per term
        return raw.select(*key, F.transform(F.array(F.sqrt(squares)), over)[0].alias("vec"))


def rare_terms(vec: Column, keep: int) -> Column:
    """The ``keep`` rarest terms of a vector with their weights unchanged."""
    return F.slice(vec, 1, keep)


def first_ids(docs: DataFrame, group: list[str], key: str, n: int) -> DataFrame:
    """The ``n`` smallest IDs per group; each task drops all but ``n`` before the shuffle."""
    order = Window.partitionBy(*group).orderBy(key)
    return docs.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")
