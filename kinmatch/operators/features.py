"""The 16 similarity columns of a pair, over already normalised fields.

Input: ``nn1, na1, cc1, nn2, na2, cc2`` and ``cosine``. Set and length features are plain column
expressions; only LCS length and best-window ratio leave the JVM, all in one Arrow exchange (one plan node).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.scorers import lcs_length, partial_ratio, ratio_of
from ..params import FEATURES
from ..session import scratch, stage


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{tx.SPACE}]+"), "")


def exact(left: Column, right: Column) -> Column:
    return ((left == right) & (left != "")).cast("double")


def jaccard(left: Column, right: Column) -> Column:
    """Token-set overlap; two empty texts are equal, one empty text shares nothing."""
    a, b = tokens(left), tokens(right)
    return _share(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def _share(met: Column, union: Column) -> Column:
    return F.when(union == 0, 1.0).otherwise(met / union)


def common_tokens(left: Column, right: Column) -> Column:
    return F.size(F.array_intersect(tokens(left), tokens(right))).cast("double")


def length_gap(left: Column, right: Column) -> Column:
    return F.abs(F.length(left) - F.length(right)).cast("double")


def sorted_text(toks: Column) -> Column:
    return F.array_join(F.sort_array(toks), " ")


def token_set_ratio(none: Column, i: Column, x: Column, y: Column, lcs: Column) -> Column:
    """Best of the leftovers ``x`` and ``y`` with the shared part (of length ``i``) in front and the shared part against each side."""
    nx, ny = F.length(x), F.length(y)
    gap = (i > 0).cast("int")
    p, q = i + gap + nx, i + gap + ny
    whole = 1.0 - (nx + ny - 2 * lcs) / (p + q)
    return (
        F.when(none, 0.0)
        .when((i > 0) & ((nx == 0) | (ny == 0)), 1.0)
        .when(i == 0, whole)
        .otherwise(F.greatest(whole, 1.0 - (gap + nx) / (i + p), 1.0 - (gap + ny) / (i + q)))
    )


STRING_SCORES = ("name_ratio", "name_token_sort", "name_token_set", "name_partial", "addr_ratio", "addr_token_set")


def _fields() -> tuple[tuple[str, Column, Column], ...]:
    return (("name", F.col("nn1"), F.col("nn2")), ("addr", F.col("na1"), F.col("na2")))


def string_scores(pairs: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Add the six string ratios (or those named in ``only``)."""
    return _scored(pairs, only or STRING_SCORES, {})


def _scored(pairs: DataFrame, wanted: tuple[str, ...], sets: dict[str, Column]) -> DataFrame:
    """Add the string ratios ``wanted`` and the columns ``sets``, which may use the ``_token_columns`` of both fields.

    A text is taken apart once, in a step of its own (a step whose columns are used more than once is not merged with
    the next), and what two texts share is found once. Token lists do not go to Python and back.
    """
    split: dict[str, Column] = {}
    shared: dict[str, Column] = {}
    texts: dict[str, Column] = {}
    lengths: dict[str, Column] = {}
    out: dict[str, Column] = {}
    for field, left, right in _fields():
        a, b, both, x, y = _token_columns(field)
        if sets or f"{field}_token_set" in wanted or f"{field}_token_sort" in wanted:
            split |= {f"_{field}_t1": tokens(left), f"_{field}_t2": tokens(right)}
        if sets or f"{field}_token_set" in wanted:
            shared |= {f"_{field}_both": F.array_intersect(a, b), f"_{field}_only1": F.array_except(a, b), f"_{field}_only2": F.array_except(b, a)}
        if f"{field}_token_sort" in wanted:
            texts |= {f"_{field}_s1": sorted_text(a), f"_{field}_s2": sorted_text(b)}
            lengths[f"_{field}_slcs"] = lcs_length(F.col(f"_{field}_s1"), F.col(f"_{field}_s2"))
            out[f"{field}_token_sort"] = ratio_of(F.col(f"_{field}_s1"), F.col(f"_{field}_s2"), F.col(f"_{field}_slcs"))
        if f"{field}_token_set" in wanted:
            texts |= {
                f"_{field}_none": (F.size(a) == 0) | (F.size(b) == 0),
                f"_{field}_i": F.length(sorted_text(both)),
                f"_{field}_x": sorted_text(x),
                f"_{field}_y": sorted_text(y),
            }
            lengths[f"_{field}_xlcs"] = lcs_length(F.col(f"_{field}_x"), F.col(f"_{field}_y"))
            out[f"{field}_token_set"] = token_set_ratio(*[F.col(f"_{field}_{part}") for part in ("none", "i", "x", "y", "xlcs")])
        if f"{field}_ratio" in wanted:
            lengths[f"_{field}_lcs"] = lcs_length(left, right)
            out[f"{field}_ratio"] = ratio_of(left, right, F.col(f"_{field}_lcs"))
    if "name_partial" in wanted:
        lengths["name_partial"] = partial_ratio(F.col("nn1"), F.col("nn2"))
    taken = pairs
    for step in (split, shared):
        taken = taken.select("*", *[c.alias(name) for name, c in step.items()]) if step else taken
    prepared = taken.select("*", *[c.alias(name) for name, c in (texts | sets).items()]).drop(*split, *shared)
    measured = prepared.select("*", *[c.alias(name) for name, c in lengths.items()])
    hidden = [name for name in (*texts, *lengths) if name.startswith("_")]
    return measured.withColumns(out).drop(*hidden)


def _token_columns(field: str) -> list[Column]:
    """Tokens of both sides, those that both have, and those that only one has; distinct but for the first two."""
    return [F.col(f"_{field}_{part}") for part in ("t1", "t2", "both", "only1", "only2")]


def set_scores() -> dict[str, Column]:
    """The features that need no UDF, by name."""
    n1, n2, a1, a2 = F.col("nn1"), F.col("nn2"), F.col("na1"), F.col("na2")
    return {
        "name_exact": exact(n1, n2),
        "name_jaccard": jaccard(n1, n2),
        "addr_exact": exact(a1, a2),
        "addr_jaccard": jaccard(a1, a2),
        "country_exact": (F.col("cc1") == F.col("cc2")).cast("double"),
        "name_len_diff": length_gap(n1, n2),
        "addr_len_diff": length_gap(a1, a2),
        "common_name_tokens": common_tokens(n1, n2),
        "common_addr_tokens": common_tokens(a1, a2),
        "tfidf_cosine": F.coalesce(F.col("cosine"), F.lit(0.0)),
    }


def add_features(sided: DataFrame) -> DataFrame:
    """All 16 columns for pairs that already carry both sides' normalised fields."""
    sets = set_scores()
    for field, _, _ in _fields():
        _, _, both, x, y = _token_columns(field)
        sets[f"{field}_jaccard"] = _share(F.size(both), F.size(F.concat(both, x, y)))
        sets[f"common_{field}_tokens"] = F.size(both).cast("double")
    return _scored(sided.drop(*sets, *STRING_SCORES), STRING_SCORES, sets)


def both_sides(pairs: DataFrame, s1: DataFrame, s23: DataFrame, strict: bool = True, unresolved: Observation | None = None) -> DataFrame:
    """Attach the normalised fields of both records to ``pairs(s1_id, c_id, ...)``.

    A candidate ID that no record has fails the job, or with ``strict=False`` drops the pair; ``unresolved``
    then holds the number of dropped ones as ``n_unresolved`` once the result was used, without a job of its own.
    """
    left = s1.select(F.col("entity_id").alias("s1_id"), F.col("nn").alias("nn1"), F.col("na").alias("na1"), F.col("cc").alias("cc1"))
    right = s23.select(F.col("entity_id").alias("c_id"), F.col("nn").alias("nn2"), F.col("na").alias("na2"), F.col("cc").alias("cc2"))
    if not strict and unresolved is None:
        return pairs.join(left, "s1_id").join(right, "c_id")
    if not strict:
        marked = pairs.join(left.withColumn("_left", F.lit(1)), "s1_id", "left").join(right.withColumn("_right", F.lit(1)), "c_id", "left")
        known = F.col("_left").isNotNull() & F.col("_right").isNotNull()
        return marked.observe(unresolved, F.count_if(~known).alias("n_unresolved")).where(known).drop("_left", "_right")
    met = pairs.join(left, "s1_id", "left").join(right, "c_id", "left")

    def sure(column: str, key: str) -> Column:
        unknown = F.raise_error(F.concat(F.lit("no record for "), F.col(key))).cast("string")
        return F.when(F.col(column).isNull(), unknown).otherwise(F.col(column))

    return met.withColumn("nn1", sure("nn1", "s1_id")).withColumn("nn2", sure("nn2", "c_id"))


#: Pairs that carry both texts at a time, up to a share of all pairs.
SLICE_PAIRS = 4_000_000
MOST_SLICES = 8


def by_slices(
    pairs: DataFrame,
    s1: DataFrame,
    s23: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    name: str,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """``make`` of :func:`both_sides` of all of the staged ``pairs``, staged (by ``keep`` of a block around, if given).

    A pair with both texts is many times as long as what is made of it. So the pairs go through in slices of whole
    records, one after the other, and the shuffle files of a slice are deleted before the next.
    """
    spark, n = pairs.sparkSession, max(1, min(MOST_SLICES, -(-pairs.count() // SLICE_PAIRS)))
    with scratch(spark) as outer:
        if n > 1:
            s1, s23 = (stage(x.select("entity_id", "nn", "na", "cc"), f"{name}-records") for x in (s1, s23))

        def of(key: str, i: int) -> Column:
            return F.pmod(F.xxhash64(key), F.lit(n)) == i

        made = [(keep or outer)(make(both_sides(pairs.where(of("s1_id", i)), s1.where(of("entity_id", i)), s23)), name) for i in range(n)]
    return reduce(DataFrame.unionByName, made)


def pair_features(pairs: DataFrame, s1: DataFrame, s23: DataFrame, strict: bool = True, unresolved: Observation | None = None) -> DataFrame:
    """``pairs`` plus the 16 feature columns. A pair without a cosine gets 0; ``strict`` and ``unresolved`` as in :func:`both_sides`."""
    if "cosine" not in pairs.columns:
        pairs = pairs.withColumn("cosine", F.lit(0.0))
    extra = [c for c in pairs.columns if c not in FEATURES]
    return add_features(both_sides(pairs, s1, s23, strict, unresolved)).select(*extra, *FEATURES)


def raw_records(raw: DataFrame) -> DataFrame:
    """``(entity_id, nn, na, cc)`` of raw ``(entity_id, business_name, business_address, country)``, normalised token by token."""
    name, address = (tx.normalize_tokens(F.col(c)) for c in ("business_name", "business_address"))
    return raw.select("entity_id", name.alias("nn"), address.alias("na"), tx.normalize_country(F.col("country")).alias("cc"))


def pair_features_raw(pairs: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Features of raw fields ``n1, a1, c1, n2, a2, c2``, normalised token by token first.

    A record is in many pairs: with ``records``, the :func:`raw_records` of both sides, their fields come from there and
    each was normalised once. Pairs whose records are not there are dropped.
    """
    if records is not None:
        sided = both_sides(pairs, records, records, strict=False)
    else:
        sided = pairs.withColumns(
            {f"{field}{side}": tx.normalize_tokens(F.col(f"{raw}{side}")) for field, raw in (("nn", "n"), ("na", "a")) for side in (1, 2)}
            | {f"cc{side}": tx.normalize_country(F.col(f"c{side}")) for side in (1, 2)}
        )
    if "cosine" not in sided.columns:
        sided = sided.withColumn("cosine", F.lit(0.0))
    return add_features(sided).select(*pairs.columns, *FEATURES)
