"""What the linkage keeps on disk: intermediate tables go, and pairs with both texts go through in slices."""

import os
from dataclasses import replace

from pyspark.sql import functions as F

from kinmatch import session
from kinmatch.operators import blocking, evaluate, features, quality, training
from kinmatch.operators.similarity import SimilarityIndex
from kinmatch.params import FEATURES, LinkParams
from kinmatch.session import scratch, shared_folder

PARAMS = LinkParams(name_k=5, addr_k=4)


def staged(spark):
    folder = f"{shared_folder(spark)}/stage"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def records(spark):
    rows = [(f"S{1 + i % 3}-{i}", 1 + i % 3, f"name{i % 40} part{i % 7} x{i % 90}", f"road{i % 30} town{i % 50}", "us") for i in range(600)]
    rows += [("S1-a", 1, "", "road1 town1", "us"), ("S2-b", 2, "", "", "us"), ("S1-c", 1, "name1 part1", None, "us")]
    df = spark.createDataFrame(rows, "entity_id string, src int, nn string, na string, cc string")
    return df.where("src = 1"), df.where("src > 1")


def test_blocking_leaves_only_its_pairs(spark):
    for block in (blocking.block, blocking.block_single):
        before = staged(spark)
        pairs = block(*records(spark), PARAMS)
        left = staged(spark) - before
        assert len(left) == 1 and left.pop().startswith("pairs-")
        assert pairs.count() > 400


def test_a_prepared_index_outlives_the_pairs(spark):
    s1, s23 = records(spark)
    with scratch(spark):
        prepared = blocking.prepare(s23, PARAMS)
        first, again = (sorted(map(tuple, blocking.block(s1, s23, PARAMS, prepared).collect()), key=str) for _ in range(2))
    assert first == again == sorted(map(tuple, blocking.block(s1, s23, PARAMS).collect()), key=str)


def test_a_staged_plan_holds_each_term_once(spark):
    s1, s23 = records(spark)
    index = SimilarityIndex(blocking.docs(s23, {"name": F.col("nn")}), PARAMS, {"name": 5})
    texts = index.query_texts(blocking.docs(s1, {"name": F.col("nn")})).dropDuplicates(["qid"])
    slim = index._slim(index._plan(index._bounds(texts)))
    assert slim.columns == ["qn", "qid", "corpus", "s", "theta", "slices"] and slim.count() > 0
    assert slim.select(F.explode("s").alias("t")).select("t.*").columns == ["tid", "w", "best", "n_vectors"]


def test_slices_hold_every_pair_once(spark, monkeypatch):
    s1, s23 = records(spark)
    s1 = s1.unionByName(s1.limit(3))  # a record given twice doubles its pairs, as in one join
    pairs = blocking.block(s1, s23, PARAMS)
    want = sorted(map(tuple, features.pair_features(pairs, s1, s23).select("s1_id", "c_id", "name_ratio", "addr_jaccard").collect()), key=str)
    monkeypatch.setattr(features, "SLICE_PAIRS", 100)
    before = staged(spark)
    made = features.by_slices(
        pairs, s1, s23, lambda sided: features.add_features(sided).select("s1_id", "c_id", "name_ratio", "addr_jaccard"), "sliced"
    )
    assert len(made.inputFiles()) >= features.MOST_SLICES
    assert all(name.startswith("sliced-") and "records" not in name for name in staged(spark) - before)
    assert sorted(map(tuple, made.collect()), key=str) == want


def test_pairs_below_every_cut_off_stay_out_of_the_join(spark):
    truth = spark.createDataFrame([("a", ["x"]), ("b", ["y"]), ("c", [])], "s1_id string, truth array<string>")
    rows = [("a", "x", 0.9), ("a", "z", 0.4), ("b", "y", 0.1), ("c", "x", None), ("c", "y", float("nan"))]
    scored = spark.createDataFrame(rows, "s1_id string, c_id string, prob double")
    got = evaluate.threshold_sweep(scored, truth, (0.8, 0.5))
    assert "(prob" in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1]
    assert {r.threshold: round(r.score, 6) for r in got.collect()} == {0.8: round(1 / 3, 6), 0.5: round(1 / 3, 6)}


def test_blocking_in_slices_finds_the_same_pairs(spark, monkeypatch):
    """Scores, answers and pairs are written in slices, whose shuffle files go before the next; nothing else stays."""
    s1, s23 = records(spark)
    want = sorted(map(tuple, blocking.block(s1, s23, PARAMS).collect()), key=str)
    monkeypatch.setattr(session, "SLICE_ROWS", 700)
    before = staged(spark)
    pairs = blocking.block(s1, s23, PARAMS)
    left = staged(spark) - before
    assert len(left) == 1 and left.pop().startswith("pairs-")
    assert len({os.path.basename(os.path.dirname(f)) for f in pairs.inputFiles()}) > 1
    assert sorted(map(tuple, pairs.collect()), key=str) == want


def test_a_fit_leaves_no_copy_of_its_pairs(spark):
    rows = [("a%d" % i, "b", float(i % 2), *[float(i % 7)] * (len(FEATURES) - 1), i % 2) for i in range(300)]
    pairs = spark.createDataFrame(rows, "s1_id string, c_id string, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int")
    before = staged(spark)
    model = training.fit(pairs, replace(PARAMS, rounds=2, depth=2, min_leaf=5), early_stop=False)
    assert staged(spark) == before
    assert model.stages[-1].featureImportances[0] > 0.9


def test_what_is_made_of_pairs_is_staged_without_them(spark, monkeypatch):
    """Neither the index nor all pairs are there while features are made of a slice."""
    s1, s23 = records(spark)
    columns = ("s1_id", "c_id", "name_jaccard", "addr_exact")
    pairs = blocking.block(s1, s23, PARAMS)
    want = sorted(map(tuple, features.pair_features(pairs, s1, s23).select(*columns).collect()), key=str)
    monkeypatch.setattr(session, "SLICE_ROWS", 700)
    before, seen = staged(spark), []

    def make(pairs, s1, s23):
        seen.append({name.rsplit("-", 1)[0] for name in staged(spark) - before})
        return features.both_sides(pairs, s1, s23).withColumns(features.set_scores()).select(*columns)

    made = blocking.block(s1, s23, PARAMS, make=make, name="made")
    assert len(seen) > 1 and all(not names & {"pairs", "postings", "vectors", "termstats", "planslice", "best"} for names in seen)
    left = staged(spark) - before
    assert len(left) == 1 and left.pop().startswith("made-")
    assert sorted(map(tuple, made.collect()), key=str) == want


def test_one_slice_of_best_vectors_is_there_at_a_time(spark, monkeypatch):
    s1, s23 = records(spark)
    monkeypatch.setattr(session, "SLICE_ROWS", 400)
    before, seen, hits = staged(spark), [], SimilarityIndex._hits

    def spy(self, best):
        seen.append(sorted(name.rsplit("-", 1)[0] for name in staged(spark) - before))
        return hits(self, best)

    monkeypatch.setattr(SimilarityIndex, "_hits", spy)
    blocking.block(s1, s23, PARAMS)
    assert len(seen) > 1 and all(names.count("best") == 1 and "queryplan" not in names for names in seen)
    assert [names.count("planslice") for names in seen] == list(range(len(seen) - 1, -1, -1))


def test_candidates_meet_links_as_lists(spark):
    links = [("a", ["x", "y"]), ("b", ["x", None]), ("c", []), ("d", ["z"]), ("e", ["x"]), (None, ["x"]), ("f", None), ("a", ["x"])]
    held = [("a", ["x"]), ("a", ["y", "x"]), ("b", ["x", None]), ("d", [None, "y"]), (None, ["x"]), ("g", ["x"])]
    frames = [spark.createDataFrame(rows, "s1_id string, ids array<string>") for rows in (links, held)]
    found = quality.check_subset(*frames)
    assert {r.s1_id for r in found.collect()} == {"b", "d", "e", None}
    assert "LeftAnti" not in found._jdf.queryExecution().optimizedPlan().toString()
