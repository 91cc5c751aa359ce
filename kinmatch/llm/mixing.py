"""Mixing domains to target token shares with soft membership. DataFrame operations only.

A naive Bayes classifier learned from a labelled table gives every document a posterior over
domains. Nonnegative rates, one a document, are then fitted so that the expected tokens of each
domain, sum of rate x tokens x posterior, match their targets: projected gradient on the whitened
least-squares objective, one aggregation over the documents a step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import stage, text_or_empty
from kinmatch.llm.exact_dedup import located
from kinmatch.session import settled


@dataclass(frozen=True)
class Params:
    """``targets``: wanted share of tokens by domain; none: present expected shares to the power ``flatten``, normalised.

    ``train_rows`` bounds the labelled rows that the classifier learns from (the smallest hashes of the id).
    """

    targets: dict[str, float] = field(default_factory=dict)
    flatten: float = 0.5
    train_rows: int = 20_000
    buckets: int = 1 << 13
    most_domains: int = 64
    #: A posterior weighs as many words as this at most, so long documents stay soft.
    evidence: float = 30.0
    steps: int = 40
    tolerance: float = 1e-5
    seed: int = 17


def _base(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, _at, n_tokens, words): words are the distinct buckets of the text's words."""
    words = F.array_remove(F.split(F.lower(text_or_empty("text")), r"[\x20\x09-\x0D]+"), "")
    bucket = F.array_distinct(F.transform(F.col("w"), lambda x: F.pmod(F.xxhash64(x), F.lit(params.buckets)).cast("int")))
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_at", words.alias("w"))
    return split.select("doc_id", "_at", F.size("w").cast("long").alias("n_tokens"), bucket.alias("words"))


def _classifier(docs: DataFrame, labelled: DataFrame, params: Params) -> tuple[list[str], list[float], DataFrame]:
    """Domains, their log priors, and per bucket the log-likelihood of each domain (``params.buckets`` rows at most)."""
    known = labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.train_rows).select(F.col("doc_id").alias("_id"), F.col("domain").alias("_domain"))
    # the base of the sample carries its domain in place of the row's place
    sample = docs.join(F.broadcast(drawn), docs.doc_id == F.col("_id")).select(F.lit(0).alias("doc_id"), "text", F.col("_domain").alias("_at"))
    seen = stage(_base(sample, params).select(F.col("_at").alias("domain"), "words"), "mix-sample")
    sizes = seen.groupBy("domain").agg(F.count("*").alias("docs"), F.sum(F.size("words")).alias("words"))
    rows = sorted(sizes.limit(params.most_domains + 1).collect())
    if len(rows) > params.most_domains:
        raise ValueError(f"more than {params.most_domains} domains")
    if not rows:
        return [], [], seen
    domains, total = [r.domain for r in rows], sum(r.docs for r in rows)
    counts = seen.select("domain", F.explode("words").alias("bucket")).groupBy("bucket").pivot("domain", domains).count()
    likelihood = [
        F.log((F.coalesce(F.col(f"`{r.domain}`"), F.lit(0)) + 1.0) / F.lit(float(r.words + params.buckets))).alias(f"l{k}") for k, r in enumerate(rows)
    ]
    model = stage(counts.select("bucket", *likelihood), "mix-model")
    return domains, [float(np.log(r.docs / total)) for r in rows], model


def posteriors(docs: DataFrame, labelled: DataFrame, params: Params = Params()) -> tuple[list[str], DataFrame]:
    """The domains and (doc_id, _at, n_tokens, p): ``p`` sums to 1; a text without words has the prior.

    Words that no labelled document has say nothing. ``labelled`` is (doc_id, domain).
    """
    base = _base(docs, params)
    domains, priors, model = _classifier(docs, labelled, params)
    if not domains:
        return [], stage(base.select("doc_id", "_at", "n_tokens", F.expr("cast(array() as array<double>)").alias("p")), "posteriors")
    told = base.select("doc_id", "_at", "n_tokens", F.explode_outer("words").alias("bucket")).join(F.broadcast(model), "bucket", "left")
    sums = [F.sum(f"l{k}").alias(f"s{k}") for k in range(len(domains))]
    told = told.groupBy("doc_id", "_at", "n_tokens").agg(F.count("l0").alias("n"), *sums)
    weight = F.try_divide(F.least(F.col("n"), F.lit(params.evidence)), F.col("n"))
    logs = [F.coalesce(F.col(f"s{k}") * weight, F.lit(0.0)) + F.lit(prior) for k, prior in enumerate(priors)]
    scored = told.select("doc_id", "_at", "n_tokens", F.array(*logs).alias("z"))
    scored = scored.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return domains, stage(scored.select("doc_id", "_at", "n_tokens", F.transform("e", lambda x: x / total).alias("p")), "posteriors")


def _dot(vector: np.ndarray) -> Column:
    return sum((F.lit(float(v)) * F.col("p")[k] for k, v in enumerate(vector)), F.lit(0.0))


def fit_rates(soft: DataFrame, domains: list[str], params: Params = Params()) -> DataFrame:
    """``soft`` with ``rate`` >= 0: the expected tokens by domain come as near to the targets as the documents allow.

    The whole keeps its number of tokens. Targets are normalised to sum to 1; a domain without a
    target gets none, one that no document belongs to can't be met and the rest share the error.
    Only sums by domain and by pair of domains reach the driver.
    """
    size = len(domains)
    pairs = [(k, m) for k in range(size) for m in range(k, size)]
    n, p = F.col("n_tokens").cast("double"), F.col("p")

    def sums(table: DataFrame, rate: Column) -> tuple[float, np.ndarray, np.ndarray]:
        """Tokens, tokens at these rates by domain, and the Gram matrix of the documents whose rate is not 0."""
        moving = F.when(rate > 0, n).otherwise(0.0)
        row = table.agg(F.sum(n), *(F.sum(n * p[k] * rate) for k in range(size)), *(F.sum(moving * p[k] * p[m]) for k, m in pairs)).first()
        gram = np.zeros((size, size))
        for (k, m), value in zip(pairs, row[size + 1 :], strict=True):
            gram[k, m] = gram[m, k] = value or 0.0
        return row[0] or 0.0, np.array(row[1 : size + 1], float), gram

    total, tokens, gram = sums(soft, F.lit(1.0)) if size else (0.0, None, None)
    if not total:
        return soft.withColumn("rate", F.lit(1.0))
    share = tokens / total
    wanted = np.array([params.targets.get(d, 0.0) for d in domains]) if params.targets else share**params.flatten
    if wanted.min() < 0 or wanted.sum() <= 0:
        raise ValueError("targets: nonnegative, not all 0, for known domains")
    wanted = wanted / wanted.sum()
    rates, rate, error = soft.withColumn("rate", F.lit(1.0)), F.col("rate"), share - wanted
    for step in range(1, params.steps + 1):
        if np.abs(error).max() <= params.tolerance:
            break
        # whitened by the documents that can move: without clipping one step meets the targets
        whiten = np.linalg.inv(gram / total + 1e-7 * np.trace(gram) / total * np.eye(size) + 1e-12 * np.eye(size))
        rate = F.greatest(F.lit(0.0), rate - _dot(whiten @ error))
        if step % 4 == 0:  # keeps the expression short and the lineage cut
            rates, rate = stage(rates.withColumn("rate", rate), "rates"), F.col("rate")
        _, tokens, gram = sums(rates, rate)
        error = tokens / total - wanted
    return rates.withColumn("rate", rate)


def mix(docs: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, _at, domain, n_tokens, posterior, rate, copies) of every row of ``docs`` (doc_id, text, ...).

    ``domain`` is the likeliest one (ties: first by name; null without any labelled row, and then all
    rates are 1). ``copies`` is the rate rounded down, and one more with the chance of what is left,
    drawn from a hash of doc_id: the same for the same id at every partitioning. Null text is empty
    and has no tokens; its rate follows the prior. Repeated rows get equal rates; null doc_ids are
    drawn alike. Extra columns are ignored; an empty table gives an empty result. ``labelled`` holds
    (doc_id, domain).
    """
    docs = docs if "_at" in docs.columns else located(docs)
    domains, soft = posteriors(docs, labelled, params)
    rated = fit_rates(soft, domains, params)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(params.seed)), F.lit(1 << 32)) / float(1 << 32)
    whole = F.floor("rate")
    copies = whole + F.when(chance < F.col("rate") - whole, 1).otherwise(0)
    names = F.array(*map(F.lit, domains)).cast("array<string>")
    likeliest = F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")) if domains else F.lit(None).cast("string")
    return rated.select("doc_id", "_at", likeliest.alias("domain"), "n_tokens", F.col("p").alias("posterior"), "rate", copies.cast("long").alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` with each row as often as its copies say, with all its columns."""
    columns, docs = docs.columns, located(docs)
    drawn = settled(docs.sparkSession, "copies", lambda: mix(docs, labelled, params).select("_at", "copies"))
    again = docs.join(drawn.hint("merge"), "_at").where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return again.select(*columns)
