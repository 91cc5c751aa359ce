"""Sampling, labelling, hold-out and the boosted-tree matcher."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import FEATURES, LinkParams
from ..session import scratch, shared_folder, stage
from . import blocking, evaluate, features
from .ranking import first_n, spread, spread_bucket


def stratified_sample(s1: DataFrame, n: int, country: str = "country", key: str = "entity_id") -> DataFrame:
    """``n`` records in proportion to the raw country, all when there are no more than ``n``.

    A country's quota is its share of ``n``, rounded; inside it the repeatable order of
    :func:`spread` decides. No country is sorted in one task.
    """
    sizes = s1.groupBy(country).agg(F.count(F.lit(1)).alias("_size"))
    total = s1.count()
    share = F.col("_size") if total <= n else F.round(n * F.col("_size") / total)
    quota = sizes.select(F.col(country), share.alias("_quota"))
    bucketed = s1.join(stage(quota, "quota"), country).withColumn("_bucket", spread_bucket(spread(key)))
    return first_n(bucketed, [country], ["_bucket"], [spread(key), F.col(key)], F.col("_quota")).select(*s1.columns)


def semi_sample(s1: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``s1`` whose ID is in ``ids(entity_id)``."""
    return s1.join(ids.select("entity_id"), "entity_id", "left_semi")


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``label``: 1 when the candidate is in the record's truth set."""
    hits = truth.select("s1_id", F.explode(F.array_distinct("truth")).alias("c_id"), F.lit(1).alias("label"))
    return pairs.join(hits, ["s1_id", "c_id"], "left").fillna(0, ["label"])


def entity_holdout(ids: DataFrame, share: float, key: str = "s1_id") -> DataFrame:
    """The held-out records: the first ceil(share x n) in the repeatable order.

    The split is by record, so all pairs of a record fall on one side.
    """
    held = math.ceil(ids.count() * share)
    bucketed = ids.select(key).withColumn("_bucket", spread_bucket(spread(key)))
    return first_n(bucketed, [], ["_bucket"], [spread(key), F.col(key)], F.lit(held)).select(key)


def split_pairs(pairs: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(training pairs, held-out pairs)``."""
    return pairs.join(held, "s1_id", "left_anti"), pairs.join(held, "s1_id", "left_semi")


def holdout_scores(held: DataFrame, scored: DataFrame) -> DataFrame:
    """Scores of the held-out records; one without candidates stays as a row with no candidate."""
    return held.select("s1_id").join(scored.select("s1_id", "c_id", "prob"), "s1_id", "left")


def blocking_recall(pairs: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """Share of true links found by blocking, per country: ``(cc, found, actual, recall)``."""
    links = truth.select("s1_id", F.explode(F.array_distinct("truth")).alias("c_id")).join(
        s1.select(F.col("entity_id").alias("s1_id"), "cc"), "s1_id"
    )
    met = links.join(pairs.select("s1_id", "c_id", F.lit(1).alias("hit")), ["s1_id", "c_id"], "left")
    sums = met.groupBy("cc").agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("actual"))
    return (
        s1.select("cc").distinct().join(sums, "cc", "left").fillna(0, ["found", "actual"])
        .withColumn("recall", F.col("found") / F.greatest(F.col("actual"), F.lit(1)))
    )


def candidates_per_s1(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """Mean list length per country and, with ``cc`` = '*', overall."""
    pairs_of = pairs.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    lists = s1.select(F.col("entity_id").alias("s1_id"), "cc").join(pairs_of, "s1_id", "left").fillna(0, ["n"])
    each = lists.groupBy("cc").agg(F.sum("n").alias("n_pairs"), F.count(F.lit(1)).alias("n_s1"))
    levels = F.array(F.col("cc"), F.lit("*"))
    return (
        each.select(F.explode(levels).alias("cc"), "n_pairs", "n_s1")
        .groupBy("cc")
        .agg((F.sum("n_pairs") / F.greatest(F.sum("n_s1"), F.lit(1))).alias("mean_candidates"))
    )


def pair_counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.coalesce(F.sum("label"), F.lit(0)).alias("n_positive")
    )


# ---------------------------------------------------------------- model


def _watched(share: float) -> Column:
    """A repeatable ``share`` of the pairs."""
    return F.pmod(F.xxhash64("s1_id", "c_id"), F.lit(1000)) < int(share * 1000)


def best_round(losses: list[float], patience: int, tolerance: float = 1e-7) -> int:
    """The round (from 1) with the least loss before ``patience`` rounds in a row bring nothing, first one on ties."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best] - tolerance:
            best = at
        elif at - best >= patience:
            break
    return best + 1


def fit(pairs: DataFrame, params: LinkParams = LinkParams(), early_stop: bool = True, rounds: int | None = None) -> PipelineModel:
    """Boosted trees over the 16 features of ``pairs(..., label)``.

    With ``early_stop`` a repeatable tenth of the pairs is left out of the fit and watches it: the
    losses of all prefixes of the ensemble come from one pass over these pairs, and the ensemble ends
    at its :func:`best_round`: the later trees are taken off, no round is run again. Without, all pairs
    and ``rounds`` rounds are used.
    The staged copy of the pairs is deleted when the model is there.
    """
    with scratch(pairs.sparkSession):
        return fit_table(stage(fit_columns(pairs, params), "train"), params, early_stop, rounds)


def fit_columns(pairs: DataFrame, params: LinkParams = LinkParams()) -> DataFrame:
    """What :func:`fit` needs of ``pairs``; once this is staged, the pairs may go."""
    watch = _watched(params.early_stop_share).alias("watch")
    return pairs.select(*FEATURES, F.col("label").cast("double").alias("label"), watch)


def fit_table(table: DataFrame, params: LinkParams = LinkParams(), early_stop: bool = True, rounds: int | None = None) -> PipelineModel:
    """:func:`fit` of the staged :func:`fit_columns`."""
    spark = table.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    ready = assembler.transform(table)

    def boosted(rows: DataFrame, number: int) -> GBTClassificationModel:
        trees = GBTClassifier(
            featuresCol="features",
            labelCol="label",
            maxIter=number,
            stepSize=params.step,
            maxDepth=params.depth,
            minInstancesPerNode=params.min_leaf,
            maxBins=params.bins,
            seed=params.seed,
            checkpointInterval=20,
        )
        return trees.fit(rows)

    number = rounds or params.rounds
    watch = ready.where("watch")
    if not early_stop or watch.isEmpty():
        return PipelineModel([assembler, boosted(ready, number)])
    learn = ready.where("NOT watch")
    model = boosted(learn, number)
    best = best_round(model.evaluateEachIteration(watch), params.patience)
    return PipelineModel([assembler, model if best == number else _prefix(spark, model, best)])


def _prefix(spark: SparkSession, model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The first ``rounds`` trees of an ensemble, which is what boosting gives after as many rounds."""
    jvm, whole = spark.sparkContext._jvm, model._java_obj
    trees = spark.sparkContext._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = spark.sparkContext._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = whole.trees()[i], whole.treeWeights()[i]
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(whole.uid(), trees, weights, whole.numFeatures(), whole.numClasses())
    return model._copyValues(GBTClassificationModel(short))


def score(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Add ``prob``, the probability of the positive class."""
    return (
        model.transform(pairs)
        .withColumn("prob", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def train_accuracy(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    right = (F.col("prediction") == F.col("label")).cast("double")
    return model.transform(pairs).agg(F.avg(right).alias("accuracy"))


@dataclass(frozen=True)
class Matcher:
    """A fitted model with its cut-off (None: that of the parameters) and hold-out score."""

    model: PipelineModel
    threshold: float | None
    val_f05: float
    rounds_tuned: int
    rounds_final: int

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.model.write().overwrite().save(f"{path}/model")
        meta = [(list(FEATURES), self.threshold, self.val_f05, self.rounds_tuned, self.rounds_final)]
        schema = "features array<string>, threshold double, val_f05 double, rounds_tuned int, rounds_final int"
        spark.createDataFrame(meta, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str, default_threshold: float | None = None) -> Matcher:
        """``default_threshold`` stands in where the bundle has no cut-off; without it the caller's parameters do."""
        meta = spark.read.parquet(f"{path}/meta").first()
        if list(meta["features"]) != list(FEATURES):
            raise ValueError("the stored model was fitted on other features")
        threshold = default_threshold if meta["threshold"] is None else meta["threshold"]
        return cls(PipelineModel.load(f"{path}/model"), threshold, meta["val_f05"], meta["rounds_tuned"], meta["rounds_final"])


def train(pairs: DataFrame, s1_ids: DataFrame, truth: DataFrame, params: LinkParams = LinkParams()) -> tuple[Matcher, DataFrame]:
    """Tune on a record-level hold-out, then refit on everything with as many rounds.

    ``pairs`` carry features and label, ``s1_ids(s1_id)`` lists every record, with or without
    candidates. Returns the matcher and the sweep it was tuned on.
    """
    ready = stage(pairs, "labelled")
    held = stage(entity_holdout(s1_ids, params.holdout), "held")
    training, checking = split_pairs(ready, held)
    tuned = fit(training, params)
    held_truth = held.join(truth, "s1_id", "left").select(
        "s1_id", F.coalesce("truth", F.array().cast("array<string>")).alias("truth")
    )
    sweep = stage(evaluate.threshold_sweep(holdout_scores(held, score(tuned, checking)), held_truth), "sweep")
    best = evaluate.best_threshold(sweep).first()
    rounds = tuned.stages[-1].getNumTrees
    final = fit(ready, params, early_stop=False, rounds=rounds)
    matcher = Matcher(final, best["threshold"], best["score"], rounds, final.stages[-1].getNumTrees)
    return matcher, sweep


def train_from_sources(s1: DataFrame, s23: DataFrame, truth: DataFrame, params: LinkParams = LinkParams()) -> tuple[Matcher, DataFrame]:
    """:func:`train` from records: sample source 1 by country, block, featurise, label, fit.

    Source 1 is cut to ``params.max_train`` records in proportion to their countries; all of sources 2
    and 3 are candidates. ``truth`` may hold more records than the sample.
    """
    sample = stage(stratified_sample(s1, params.max_train, "cc"), "train-records")
    pairs = blocking.block(sample, s23, params)
    labelled = label_pairs(features.pair_features(pairs, sample, s23), truth)
    return train(labelled, sample.select(F.col("entity_id").alias("s1_id")), truth, params)
