"""Candidate generation: exact names, name similarity and address similarity, merged in order.

Frames: ``records(entity_id, src, nn, na, cc, ord)`` in, ``pairs(s1_id, c_id, pos, via_exact,
name_score, addr_score, cosine)`` out. The country is part of every key, so all countries run
together and an unseen country needs no special case.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..params import LinkParams
from ..session import in_slices, scratch, scratch_path, slice_count, slice_of, stage
from .similarity import SimilarityIndex
from .tfidf import digest

EXACT, NAME, ADDR = 0, 1, 2


def docs(records: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """``(corpus, id, text)``: one document per record and field."""
    parts = F.array(
        *[F.struct(F.concat(F.lit(f"{name}:"), F.col("cc")).alias("corpus"), text.alias("text")) for name, text in fields.items()]
    )
    return records.select(F.col("entity_id").alias("id"), F.explode(parts).alias("d")).select("d.corpus", "id", "d.text")


def exact_names(s1: DataFrame, s23: DataFrame, cap: int) -> DataFrame:
    """Namesakes in the same country: ``(s1_id, c_id, pos, score, namesakes)``.

    Candidates come in the order (source, ID). Nothing past ``cap`` can enter a list of ``cap``
    candidates, so each name offers its first ``cap`` IDs once instead of pairing whole groups of
    namesakes; ``namesakes`` still counts them all.
    """
    found = exact_lists(s1, s23, cap).select("s1_id", F.posexplode("hits").alias("at", "c_id"), "namesakes")
    return found.select("s1_id", "c_id", (F.col("at") + 1).alias("pos"), "namesakes")


def exact_lists(s1: DataFrame, s23: DataFrame, cap: int) -> DataFrame:
    """:func:`exact_names` as one list a record: ``(s1_id, hits, namesakes)``."""
    named = s23.where(F.col("nn") != "").select("cc", digest(F.col("nn")).alias("dg"), "src", "entity_id")
    order = Window.partitionBy("cc", "dg").orderBy("src", "entity_id")
    first = (
        named.withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= cap)
        .groupBy("cc", "dg")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "entity_id"))), lambda x: x["entity_id"]).alias("hits"))
    )
    sizes = named.groupBy("cc", "dg").agg(F.count(F.lit(1)).alias("namesakes"))
    return (
        s1.where(F.col("nn") != "")
        .select("cc", digest(F.col("nn")).alias("dg"), F.col("entity_id").alias("s1_id"))
        .join(first.join(sizes, ["cc", "dg"]), ["cc", "dg"])
        .select("s1_id", "hits", "namesakes")
    )


def exact_name_groups(s1: DataFrame, s23: DataFrame) -> DataFrame:
    """All exact-name matches, factorised: ``(entity_id, src, cc, name_group, namesakes)``.

    A source-1 record matches every candidate record with its ``cc`` and ``name_group``;
    ``namesakes`` is their number. One row per record, so a name that a third of the rows bear
    costs no more than its rows, and nothing is cut. Groups with one side only are left out.
    """
    named = s1.select("entity_id", "src", "cc", "nn").unionByName(s23.select("entity_id", "src", "cc", "nn")).where(F.col("nn") != "")
    named = named.select("entity_id", "src", "cc", digest(F.col("nn")).alias("dg"))
    sizes = named.groupBy("cc", "dg").agg(F.count_if(F.col("src") > 1).alias("namesakes"), F.count_if(F.col("src") == 1).alias("n_s1"))
    both = sizes.where("namesakes > 0 AND n_s1 > 0").select("cc", "dg", "namesakes")
    return named.join(both, ["cc", "dg"]).select("entity_id", "src", "cc", F.lower(F.hex("dg")).alias("name_group"), "namesakes")


def stream(s1: DataFrame, s23: DataFrame, fields: dict[str, Column], k_of: dict[str, int], params: LinkParams) -> DataFrame:
    """Similarity top-K over one or more text fields: ``(corpus, s1_id, c_id, rank, score)``."""
    index = SimilarityIndex(docs(s23, fields), params, k_of)
    return index.top_k(docs(s1, fields))


def _slim(records: DataFrame, name: str) -> DataFrame:
    """Normalise once: several passes read these columns."""
    return stage(records.select("entity_id", "src", "nn", "na", "cc"), name)


def _once(s1: DataFrame, s23: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _slim(s1, "s1"), _slim(s23, "s23")


def name_stream(s1: DataFrame, s23: DataFrame, params: LinkParams = LinkParams()) -> DataFrame:
    s1, s23 = _once(s1, s23)
    return stream(s1, s23, {"name": F.col("nn")}, {"name": params.name_k}, params).drop("corpus")


def addr_stream(s1: DataFrame, s23: DataFrame, params: LinkParams = LinkParams()) -> DataFrame:
    s1, s23 = _once(s1, s23)
    return stream(s1, s23, {"addr": F.col("na")}, {"addr": params.addr_k}, params).drop("corpus")


def merge_streams(found: DataFrame, cap: int) -> DataFrame:
    """Merge the lists ``found(s1_id, stream, hits)`` of ``(c_id, score)`` in order; first occurrence wins, cut at ``cap``.

    A source-1 record brings at most exact cap + K + K hits, so one exchange of its lists carries both
    the folding of repeats and the numbering.
    """
    at = F.struct("stream", "rank")
    merged = (
        found.repartition("s1_id")
        .select("s1_id", "stream", F.posexplode("hits").alias("rank", "h"))
        .select("s1_id", "stream", "rank", "h.c_id", "h.score")
        .groupBy("s1_id", "c_id")
        .agg(
            F.min(at).alias("at"),
            F.max((F.col("stream") == EXACT).cast("int")).alias("via_exact"),
            F.max(F.when(F.col("stream") == NAME, F.col("score"))).alias("name_score"),
            F.max(F.when(F.col("stream") == ADDR, F.col("score"))).alias("addr_score"),
        )
    )
    order = Window.partitionBy("s1_id").orderBy("at")
    return (
        merged.withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= cap)
        .select("s1_id", "c_id", "pos", "via_exact", "name_score", "addr_score")
    )


def pair_cosine(addr_weight: float) -> Column:
    """Name score when the name stream found the pair, else the damped address score, else 1."""
    return F.coalesce(F.col("name_score"), F.lit(addr_weight) * F.col("addr_score"), F.lit(1.0))


def _exact_hits(s1: DataFrame, s23: DataFrame, cap: int) -> DataFrame:
    hits = F.transform("hits", lambda c: F.struct(c.alias("c_id"), F.lit(1.0).alias("score")))
    return exact_lists(s1, s23, cap).select("s1_id", F.lit(EXACT).alias("stream"), hits.alias("hits"))


@dataclass(frozen=True)
class Prepared:
    """The candidate side of :func:`block`: normalised records and their index, for any number of source-1 tables."""

    s23: DataFrame
    index: SimilarityIndex


def _both_fields() -> dict[str, Column]:
    return {"name": F.col("nn"), "addr": F.col("na")}


def _index(s23: DataFrame, params: LinkParams) -> SimilarityIndex:
    return SimilarityIndex(docs(s23, _both_fields()), params, {"name": params.name_k, "addr": params.addr_k})


def prepare(s23: DataFrame, params: LinkParams = LinkParams()) -> Prepared:
    s23 = _slim(s23, "s23")
    return Prepared(s23, _index(s23, params))


#: What is made of a slice of the pairs, its source-1 records and the candidate records, both normalised.
Made = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]


def block(
    s1: DataFrame,
    s23: DataFrame,
    params: LinkParams = LinkParams(),
    prepared: Prepared | None = None,
    make: Made | None = None,
    name: str = "pairs",
) -> DataFrame:
    """Candidate pairs of every source-1 record, in list order, staged. ``prepared`` stands for ``s23`` if given.

    With ``make``, what it makes of each slice of the pairs is staged in place of them: the pairs are never all there.
    """
    spark = s1.sparkSession
    path = scratch_path(spark, f"stage/{name}")
    with scratch(spark):
        s1, s23 = _slim(s1, "s1"), prepared.s23 if prepared else _slim(s23, "s23")
        answers = scratch_path(spark, "stage/answers")
        with scratch(spark):  # an index of its own goes before the merge
            index = prepared.index if prepared else _index(s23, params)
            stream = F.when(F.col("corpus").startswith("name:"), NAME).otherwise(ADDR).alias("stream")
            similar = index.top_lists(docs(s1, _both_fields()), answers).select("s1_id", stream, "hits")
        return _merged(path, s1, s23, similar, index.k_max, params.cap, params, make)


def _merged(
    path: str, s1: DataFrame, s23: DataFrame, similar: DataFrame, k: int, cap: int, params: LinkParams, make: Made | None = None
) -> DataFrame:
    """The pairs of the exact names and of the staged lists ``similar`` of up to ``k`` hits, staged at ``path`` in slices of whole records.

    The cosine follows from the scores, so it is worked out when the pairs are read. ``make`` as in :func:`block`.
    """
    spark, n = s1.sparkSession, slice_count(similar.count() * k)
    exact = _exact_hits(s1, s23, cap)
    found = (stage(exact, "exact") if n > 1 else exact).unionByName(similar)

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("cosine", pair_cosine(params.addr_weight))

    def merged(i: int) -> DataFrame:
        pairs = merge_streams(found.where(slice_of("s1_id", i, n)), cap)
        return pairs if make is None else make(scored(pairs), s1.where(slice_of("entity_id", i, n)), s23)

    made = in_slices(spark, path, n, merged)
    return scored(made) if make is None else made


def block_single(s1: DataFrame, s23: DataFrame, params: LinkParams = LinkParams()) -> DataFrame:
    """One stream over the weighted text (name twice, then address) plus exact names, staged."""
    spark = s1.sparkSession
    path = scratch_path(spark, "stage/pairs")
    with scratch(spark):
        s1, s23 = _once(s1, s23)
        fields = {"text": tx.blocking_text(F.col("nn"), F.col("na"))}
        answers = scratch_path(spark, "stage/answers")
        with scratch(spark):
            index = SimilarityIndex(docs(s23, fields), params, {"text": params.single_k})
            similar = index.top_lists(docs(s1, fields), answers).select("s1_id", F.lit(NAME).alias("stream"), "hits")
        return _merged(path, s1, s23, similar, index.k_max, params.single_cap, params)


def candidate_arrays(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(s1_id, candidates)`` for every source-1 record, empty list included."""
    lists = pairs.groupBy("s1_id").agg(F.sort_array(F.collect_list(F.struct("pos", "c_id"))).alias("l"))
    return (
        s1.select(F.col("entity_id").alias("s1_id"))
        .join(lists, "s1_id", "left")
        .select("s1_id", F.coalesce(F.transform("l", lambda x: x["c_id"]), F.array().cast("array<string>")).alias("candidates"))
    )
