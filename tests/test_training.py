from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import evaluate, features, inference, training
from kinmatch.params import FEATURES, THRESHOLDS, LinkParams
from kinmatch.plans import fixtures as fx
from kinmatch.plans import queries as q
from kinmatch.session import stage
from kinmatch.sources import tables


@pytest.fixture(scope="module")
def world(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    truth = stage(q.truth(spark, sf), "truth")
    pairs = q.pairs(spark, sf)
    labelled = stage(training.label_pairs(features.pair_features(pairs, s1, s23), truth), "lab")
    ids = s1.select(F.col("entity_id").alias("s1_id"))
    matcher, sweep = training.train(labelled, ids, truth, q.SMALL_TREES)
    return s1, s23, truth, pairs, labelled, matcher, sweep


def test_model_beats_every_single_feature(world):
    _, _, truth, _, labelled, matcher, _ = world
    scored = training.score(matcher.model, labelled)
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored, truth)).first().score
    for name in FEATURES:
        top = labelled.agg(F.max(name)).first()[0] or 1.0
        single = labelled.select("s1_id", "c_id", (F.col(name) / top).alias("prob"))
        assert best > evaluate.best_threshold(evaluate.threshold_sweep(single, truth)).first().score, name
    assert training.train_accuracy(matcher.model, labelled).first()[0] > 0.95


def test_sweep_and_rounds(world):
    *_, matcher, sweep = world
    assert [r.threshold for r in sweep.orderBy("threshold").collect()] == list(THRESHOLDS)
    assert matcher.threshold in THRESHOLDS and q.SMALL_TREES.rounds >= matcher.rounds_tuned == matcher.rounds_final


def test_best_round():
    assert training.best_round([5.0, 4.0, 3.0], 30) == 3
    assert training.best_round([5.0, 4.0, 4.5, 4.2, 1.0], 2) == 2  # ends before the last round
    assert training.best_round([5.0, 4.0, 4.5, 4.2, 1.0], 3) == 5
    assert training.best_round([5.0, 5.0, 5.0], 30) == 1
    assert training.best_round([5.0, 5.0 - 1e-9], 30) == 1


def test_ensemble_ends_at_the_best_watched_round(world):
    *_, labelled, _, _ = world
    # a quarter of the labels is wrong, so trees soon learn what does not hold elsewhere
    wrong = F.pmod(F.xxhash64("c_id", "s1_id"), F.lit(4)) == 0
    labelled = stage(labelled.withColumn("label", F.when(wrong, 1 - F.col("label")).otherwise(F.col("label"))), "noisy")
    few = replace(q.SMALL_TREES, rounds=12, step=1.0, depth=6, min_leaf=1, patience=3)
    longer = replace(few, early_stop_share=0.0)
    watched = training._watched(few.early_stop_share)
    learn, watch = labelled.where(~watched), stage(labelled.where(watched), "watch")
    whole = training.fit(learn, longer, early_stop=False)
    losses = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(watch.withColumn("label", F.col("label").cast("double"))))
    tuned = training.fit(labelled, few)
    best = training.best_round(losses, few.patience)
    assert tuned.stages[-1].getNumTrees == best < 12
    # the shorter ensemble is a prefix of the longer one
    nodes = [[t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees] for m in (tuned, whole)]
    assert nodes[0] == nodes[1][:best]
    again = training.fit(labelled.where(~watched), replace(longer, rounds=best), early_stop=False)  # all its rounds run, no more
    assert again.stages[-1].featureImportances == tuned.stages[-1].featureImportances
    probs = [training.score(m, watch).orderBy("s1_id", "c_id").select("prob").collect() for m in (again, tuned)]
    assert probs[0] == probs[1]


def test_early_stop_fits_once(world, monkeypatch):
    *_, labelled, _, _ = world
    runs, fitted = [], training.GBTClassifier.fit
    monkeypatch.setattr(training.GBTClassifier, "fit", lambda self, rows: runs.append(self.getMaxIter()) or fitted(self, rows))
    monkeypatch.setattr(training, "best_round", lambda losses, patience: 2)
    tuned = training.fit(labelled, replace(q.SMALL_TREES, rounds=4, depth=2))
    assert runs == [4] and tuned.stages[-1].getNumTrees == 2 and tuned.stages[-1].getMaxDepth() == 2


def test_fit_queries_fit_the_whole_ensemble(world, spark, sf, monkeypatch):
    """The registered fits take the production parameters, not those of small trees."""
    *_, labelled, _, _ = world
    seen, fit = [], training.fit_table

    def short(table, params, early_stop=True, rounds=None):
        seen.append(params)
        return fit(table, replace(params, rounds=2, depth=2), early_stop, rounds)

    monkeypatch.setattr(training, "fit_table", short)
    monkeypatch.setattr(q, "_labelled", lambda *_: labelled)
    for name in ("gbt_fit", "gbt_refit"):
        assert q.QUERIES[name](spark, sf).count() == len(FEATURES)
    assert [(p.rounds, p.depth, p.min_leaf, p.step) for p in seen] == [(300, 8, 50, 0.06)] * 2


def test_training_from_sources_samples_by_country(world, monkeypatch):
    s1, s23, truth, *_ = world
    seen = []
    monkeypatch.setattr(training, "train", lambda pairs, ids, *rest: seen.append((pairs, ids)))
    training.train_from_sources(s1, s23, truth, replace(q.SMALL_TREES, max_train=60))
    pairs, ids = seen[0]
    drawn = ids.withColumnRenamed("s1_id", "entity_id").join(s1, "entity_id").groupBy("cc").count().collect()
    assert {r.cc: r["count"] for r in drawn} == {"us": 27, "india": 24, "france": 9}
    assert pairs.join(ids, "s1_id", "left_anti").count() == 0 and pairs.where("label = 1").count() > 0


def test_holdout_is_by_record(world):
    s1, _, _, _, labelled, _, _ = world
    held = training.entity_holdout(s1.select(F.col("entity_id").alias("s1_id")), 0.2)
    assert held.count() == 40
    train, check = training.split_pairs(labelled, held)
    assert train.count() + check.count() == labelled.count()
    assert train.select("s1_id").distinct().join(check, "s1_id").count() == 0


def test_stratified_sample_takes_all_when_few(world, spark, sf):
    s1 = fx.catalog_sources(spark, sf).where("src = 1")
    assert training.stratified_sample(s1, 10_000).count() == s1.count()


def test_slice_equals_full_run(world):
    s1, s23, _, _, _, matcher, _ = world
    _, links = inference.match(s1, s23, matcher)
    part = inference.slice_s1(s1, "india", 5, 40, F.floor(F.col("ord") / 16))
    _, some = inference.match_slice(s1, s23, matcher, "india", 5, 40, coarse=F.floor(F.col("ord") / 16))
    want = {tuple(r) for r in links.join(part.select(F.col("entity_id").alias("s1_id")), "s1_id").select("s1_id", "c_id", "pos").collect()}
    assert part.count() == 35 and {tuple(r) for r in some.select("s1_id", "c_id", "pos").collect()} == want


def test_fewer_links_at_higher_cut(world):
    *_, labelled, matcher, _ = world
    scored = stage(training.score(matcher.model, labelled), "sc")
    sizes = [inference.apply_threshold(scored, t).count() for t in THRESHOLDS]
    assert sizes == sorted(sizes, reverse=True)


def test_bundle(world, spark, tmp_path):
    *_, labelled, matcher, _ = world
    matcher.save(str(tmp_path / "m"))
    again = training.Matcher.load(spark, str(tmp_path / "m"))
    assert again.threshold == matcher.threshold
    a = training.score(matcher.model, labelled).agg(F.sum("prob")).first()[0]
    b = training.score(again.model, labelled).agg(F.sum("prob")).first()[0]
    assert a == pytest.approx(b)
    replace(matcher, threshold=None).save(str(tmp_path / "n"))
    assert training.Matcher.load(spark, str(tmp_path / "n"), LinkParams.threshold).threshold == 0.65


def test_bundle_without_a_cut_off_takes_that_of_the_parameters(world, spark, tmp_path):
    s1, s23, _, pairs, _, matcher, _ = world
    replace(matcher, threshold=None).save(str(tmp_path / "m"))
    bare = training.Matcher.load(spark, str(tmp_path / "m"))
    assert bare.threshold is None
    lists = tables.candidate_lists(s1, pairs).drop("ord")

    def found(m, params=LinkParams()):
        return sorted(tuple(r) for r in inference.rescore(lists, s1, s23, m, params=params).collect())

    assert found(bare) == found(replace(matcher, threshold=0.55)) != []
    assert found(bare, replace(LinkParams(), rescore_threshold=0.999)) == []
    _, a = inference.match(s1, s23, bare)
    _, b = inference.match(s1, s23, replace(matcher, threshold=0.65))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rescore(world, spark):
    s1, s23, _, pairs, _, matcher, _ = world
    lists = tables.candidate_lists(s1, pairs).drop("ord")
    with_cosine = inference.rescore(lists, s1, s23, matcher, stored=pairs)
    _, direct = inference.match(s1, s23, matcher)
    assert {(r.s1_id, r.c_id) for r in with_cosine.collect()} == {(r.s1_id, r.c_id) for r in direct.collect()}
    unknown = spark.createDataFrame([("S1-1", "S2-nobody")], "source1_entity_id string, candidate_entity_ids string")
    with pytest.raises(Exception, match="no record for"):
        inference.rescore(unknown, s1, s23, matcher).collect()
    assert inference.rescore(unknown, s1, s23, matcher, strict=False).count() == 0
