"""From source tables to link lists: full run, slice of one country, re-scoring of stored lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..params import LinkParams
from ..sources import tables
from . import blocking, features
from .ranking import row_range
from .training import Matcher, score


def slice_s1(s1: DataFrame, country: str, start: int, end: int, coarse: Column | None = None) -> DataFrame:
    """Rows ``start`` up to ``end`` of one country in file order.

    ``coarse`` groups neighbouring rows (by default the file block), so a country is counted by
    block and only the blocks the slice touches are numbered.
    """
    block = F.struct("ord.file", "ord.block") if coarse is None else coarse
    rows = s1.where(F.col("cc") == country).withColumn("_block", block)
    return row_range(rows, ["cc"], "_block", [F.col("ord")], start, end).drop("_block")


def apply_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    """Pairs at or above the cut-off; list order is kept in ``pos``, no score means 0."""
    return scored.where(F.coalesce("prob", F.lit(0.0)) >= threshold).select("s1_id", "c_id", "pos", "prob")


def match(
    s1: DataFrame,
    s23: DataFrame,
    matcher: Matcher,
    params: LinkParams = LinkParams(),
    prepared: blocking.Prepared | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(candidate pairs, linked pairs)`` of every source-1 record, all countries in one run.

    ``prepared`` is the candidate side of ``s23`` where several tables are matched against it.
    """
    pairs = blocking.block(s1, s23, params, prepared)  # both results hang on it
    threshold = params.threshold if matcher.threshold is None else matcher.threshold

    def linked(sided: DataFrame) -> DataFrame:
        return apply_threshold(score(matcher.model, features.add_features(sided)), threshold)

    # prepared records were normalised once for all tables
    return pairs, features.by_slices(pairs, s1, prepared.s23 if prepared else s23, linked, "links")


def match_slice(
    s1: DataFrame,
    s23: DataFrame,
    matcher: Matcher,
    country: str,
    start: int,
    end: int,
    params: LinkParams = LinkParams(),
    coarse: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """As :func:`match` for a slice; equal to the same rows of a full run, because only the
    candidate side is fitted."""
    part = slice_s1(s1, country, start, end, coarse)
    return match(part, s23.where(F.col("cc") == country), matcher, params)


def rescore(
    lists: DataFrame,
    s1: DataFrame,
    s23: DataFrame,
    matcher: Matcher,
    stored: DataFrame | None = None,
    strict: bool = True,
    params: LinkParams = LinkParams(),
    unresolved: Observation | None = None,
) -> DataFrame:
    """Score stored candidate lists again, without blocking: linked pairs.

    With ``strict=False`` unknown candidate IDs are dropped; ``unresolved`` counts them in the job that uses the result.

    The cosine is 0 unless ``stored(s1_id, c_id, cosine)`` brings it along. A matcher without a
    cut-off takes ``params.rescore_threshold``.
    """
    pairs = tables.explode_lists(lists, s1)
    if stored is not None:
        pairs = pairs.join(stored.select("s1_id", "c_id", "cosine"), ["s1_id", "c_id"], "left")
    scored = score(matcher.model, features.pair_features(pairs, s1, s23, strict, unresolved))
    return apply_threshold(scored, params.rescore_threshold if matcher.threshold is None else matcher.threshold)
