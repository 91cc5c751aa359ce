"""The similarity join against a plain Python calculation, on data with hot terms and copies."""

import math
import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import blocking, similarity, tfidf
from kinmatch.operators.similarity import SimilarityIndex
from kinmatch.params import LinkParams
from kinmatch.session import stage

PARAMS = LinkParams(name_k=5, addr_k=4)


def terms(text):
    toks = [t for t in text.split() if len(t) > 1]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def brute_force(s1, s23, k, keep=6):
    out = {}
    for cc in {r[2] for r in s1}:
        docs = {r[0]: Counter(terms(r[1])) for r in s23 if r[2] == cc}
        n = len(docs)
        df = Counter(t for c in docs.values() for t in c)
        vocab = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if 2 <= d <= 0.1 * n} if 0.1 * n >= 2 else {}

        def weigh(counter):
            raw = {t: c * vocab[t] for t, c in counter.items() if t in vocab}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            return {t: x / norm for t, x in raw.items()}

        vectors = {i: weigh(c) for i, c in docs.items()}
        for sid, text, country in s1:
            if country != cc:
                continue
            q = weigh(Counter(terms(text)))
            q = {t: q[t] for t in sorted(q, key=lambda t: (df[t], t))[:keep]}
            scored = [
                (-math.floor(s * 1e9 + 0.5), i)
                for i, v in vectors.items()
                if any(t in v for t in q)
                for s in [sum(w * v[t] for t, w in q.items() if t in v)]
            ]
            out[sid] = [i for _, i in sorted(scored)[:k]]
    return out


def make(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 3) for i in range(60)]

    def text():
        if rng.random() < 0.3:
            return "copy of one same name"  # a third of all records
        return " ".join(rng.choices(words, weights, k=rng.randint(0, 6)))

    s1 = [(f"S1-{i}", text(), rng.choice(["us", "us", "us", "fr"])) for i in range(n)]
    s23 = [(f"S{2 + i % 2}-{i}", text(), rng.choice(["us", "us", "us", "fr", "xx"])) for i in range(2 * n)]
    s1.append(("S1-x", "w1 w2", "only here"))
    return s1, s23


def frames(spark, s1, s23, parts=3):
    schema = "entity_id string, nn string, cc string"

    def frame(rows):
        return (
            spark.createDataFrame(rows, schema).repartition(parts)
            .withColumn("src", F.substring("entity_id", 2, 1).cast("int")).withColumn("na", F.lit(""))
        )

    return frame(s1), frame(s23)


def found(df):
    lists = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.s1_id, r["rank"])):
        lists[r.s1_id].append(r.c_id)
    return dict(lists)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cells,slices", [((32768, 4096), 1_000_000), ((3, 2), 20)])
def test_top_k_is_exact(spark, seed, cells, slices):
    """Once with everything in one cell and slice, once with lists and queries cut into many."""
    s1, s23 = make(seed, 150)
    params = replace(PARAMS, cell_postings=cells[0], cell_queries=cells[1], slice_pairs=slices)
    got = found(blocking.name_stream(*frames(spark, s1, s23), params))
    want = {k: v for k, v in brute_force(s1, s23, PARAMS.name_k).items() if v}
    assert got == want


def test_some_terms_never_lead(spark):
    """A rare and a common term together: the common one alone cannot reach the top K."""
    s23 = [(f"S2-a{i}", f"rare u{i}", "us") for i in range(8)] + [(f"S3-b{i}", f"mid common v{i} v{i + 1}", "us") for i in range(40)]
    s23 += [(f"S2-c{i}", f"f{i} f{i + 1}", "us") for i in range(400)]
    s1 = [("S1-1", "rare common", "us"), ("S1-2", "common", "us"), ("S1-3", "f1 f2 rare common", "us")]
    params = replace(PARAMS, name_k=5)
    left, right = frames(spark, s1, s23)
    index = SimilarityIndex(blocking.docs(right, {"name": F.col("nn")}), params, {"name": 5})
    texts = index.query_texts(blocking.docs(left, {"name": F.col("nn")}))
    plan = index._plan(index._bounds(texts.dropDuplicates(["qid"]))).collect()
    assert any(r.rest for r in plan)
    got = found(index.top_k(blocking.docs(left, {"name": F.col("nn")})).drop("corpus"))
    assert got == brute_force(s1, s23, 5)


def test_first_slice_bounds_the_others(spark):
    """What the first slice reaches spares the other slices postings, and the answer stays."""
    s1, s23 = make(3, 400)
    params = replace(PARAMS, slice_pairs=60)
    left, right = (blocking.docs(x, {"name": F.col("nn")}) for x in frames(spark, s1, s23))
    index = SimilarityIndex(right, params, {"name": 5})
    texts = index.query_texts(left).dropDuplicates(["qid"])
    plan = stage(index._plan(index._bounds(texts)), "plan")
    assert plan.where("slices > 1").count() > 10
    first = stage(index.scores(plan, F.col("slice") == 0), "first")
    raised = stage(index._raised(plan, first), "raised")
    assert raised.join(plan.select("qn", F.col("theta").alias("before")), "qn").where("theta > before").count() > 10
    assert raised.join(plan.select("qn", F.col("slices").alias("before")), "qn").where("slices <> before").count() == 0
    later = F.col("slice") > 0
    known, unknown = (stage(index.scores(p, later), "later") for p in (raised, plan))
    assert 0 < known.count() < unknown.count()
    want = {k: v for k, v in brute_force(s1, s23, 5).items() if v}
    assert found(index.top_k(left).drop("corpus")) == want


def test_what_moves_does_not_grow_with_slices_and_small_cells(spark):
    """A query goes to no more than two slices of ``MOST_SPLITS`` cells, a posting to no more blocks, however small they are set."""
    s1, s23 = make(4, 600)
    params = replace(PARAMS, cell_postings=1, cell_queries=1, slice_pairs=5)
    left, right = (blocking.docs(x, {"name": F.col("nn")}) for x in frames(spark, s1, s23))
    index = SimilarityIndex(right, params, {"name": 5})
    plan = stage(index._slim(index._plan(index._bounds(index.query_texts(left).dropDuplicates(["qid"])))), "plan")
    assert plan.agg(F.max("slices")).first()[0] > 10
    dealt, terms = index._cells(plan, 1000)
    assert dealt.agg(F.max("c_split"), F.max("q_split")).first() == (similarity.MOST_SPLITS,) * 2
    assert terms.agg(F.max(F.size("blocks"))).first()[0] <= similarity.MOST_SPLITS * 3  # three countries
    counts = index.scores(plan, None, 1000).groupBy("qn").count()
    assert counts.where(F.col("count") > 2 * 5).isEmpty()
    assert found(index.top_k(left).drop("corpus")) == {k: v for k, v in brute_force(s1, s23, 5).items() if v}


def test_catalogue_texts_are_normalised_in_many_tasks(spark, tmp_path):
    """A part file of one block is dealt over tasks before its texts are made."""
    from kinmatch.plans import fixtures as fx

    rows = [(i, "large ring", "Brand#7", ("SMALL", "PROMO")[i % 2], 3) for i in range(400)] + [(None, None, None, None, None)]
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    raw = fx.catalog_sources(spark, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "part.parquet")).rdd.getNumPartitions() == 1
    assert raw.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and raw.count() == 802


def test_terms_of_every_record_are_dropped_before_the_exchange(spark):
    rows = [(f"{i:03d}", f"every one u{i % 40} v{i % 30}") for i in range(300)]
    docs = spark.createDataFrame(rows, "id string, text string").withColumn("corpus", F.lit("name:us"))
    space = tfidf.TermSpace(docs, PARAMS)
    assert {r.term for r in space.heavy.collect()} == {"every", "one", "every one"}
    assert space.few_heavy and space.counts.where("term = 'every'").count() > 0
    left = space.without_heavy(space.counts)
    assert left.where("term IN ('every', 'one', 'every one')").count() == 0
    plan = left.join(space.vocab.hint("merge"), ["corpus", "term"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(corpus") < plan.index("BroadcastHashJoin [corpus")  # outermost first
    small = tfidf.TermSpace(docs.where("id < '015'"), PARAMS)  # too few documents for the limits
    assert small.heavy.count() == 0 and small.vocab.count() == 0


def test_partitioning_does_not_matter(spark):
    s1, s23 = make(5, 100)
    once = found(blocking.name_stream(*frames(spark, s1, s23, 1), PARAMS))
    again = found(blocking.name_stream(*frames(spark, s1[::-1], s23[::-1], 9), PARAMS))
    assert once == again


def test_block_merges_in_order(spark):
    """More namesakes than the list holds: only they remain, in (source, ID) order."""
    s23 = [(f"S{2 + i % 2}-{i:03d}", "acme foods", "us") for i in range(80)] + [(f"S2-z{i}", f"t{i % 30} u{i % 30}", "us") for i in range(900)]
    s1 = [("S1-1", "acme foods", "us"), ("S1-2", "t3 u3", "us"), ("S1-3", "nothing", "us"), ("S1-4", "", "us")]
    pairs = blocking.block(*frames(spark, s1, s23), LinkParams()).collect()
    lists = {s: [r.c_id for r in sorted(pairs, key=lambda r: r.pos) if r.s1_id == s] for s, _, _ in s1}
    assert lists["S1-1"] == sorted((i for i, n, _ in s23 if n == "acme foods"), key=lambda i: (i[1], i))[:42]
    assert len(lists["S1-2"]) == 30 and not lists["S1-3"] and not lists["S1-4"]
    assert all(r.cosine == pytest.approx(1.0) for r in pairs)
    everyone = blocking.candidate_arrays(frames(spark, s1, s23)[0], blocking.block(*frames(spark, s1, s23)))
    assert {r.s1_id: len(r.candidates) for r in everyone.collect()} == {"S1-1": 42, "S1-2": 30, "S1-3": 0, "S1-4": 0}


def test_pairs_do_not_move(spark, tmp_path):
    """Rows that leave a block and a cell are a query's best, not the pairs that were compared."""
    s23 = [(f"S2-{i:04d}", f"hot{i % 12} tail{i % 300}", "us") for i in range(1200)]
    s1 = [(f"S1-{i:04d}", f"hot{i % 12} tail{i % 7}", "us") for i in range(200)]
    left, right = (blocking.docs(x, {"name": F.col("nn")}) for x in frames(spark, s1, s23))
    index = SimilarityIndex(right, PARAMS, {"name": 5})
    texts = index.query_texts(left).dropDuplicates(["qid"])
    plan = stage(index._plan(index._bounds(texts)), "plan")
    scores = index.scores(plan)
    executed = scores._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in executed and "hashpartitioning(qn" in executed
    assert scores.groupBy("qn").count().where("count > 5").isEmpty()
    assert found(index.top_k(left).drop("corpus")) == {k: v for k, v in brute_force(s1, s23, 5).items() if v}


def test_cell_gives_the_ids_of_better_vectors_first():
    """K IDs of strictly better vectors leave no room; vectors of equal score go by number."""
    import pyarrow as pa

    from kinmatch.operators import cellscores

    offered = pa.table({"tid": [1, 1, 1, 1], "vn": [9, 4, 7, 5], "n_ids": pa.array([2, 1, 1, 3], pa.int32()), "w": [0.9, 0.5, 0.5, 0.4]})
    asked = {"qn": [1], "slice": [0], "slices": [1], "theta": [0.0], "tids": [[1, 2]], "ws": [[0.5, 0.5]]}

    def vectors(k):
        return cellscores.best_in_cell(pa.table(asked | {"k": pa.array([k], pa.int32())}), offered)["vn"].to_pylist()

    assert vectors(2) == [9] and vectors(3) == [9, 4, 7] and vectors(5) == [9, 4, 7, 5]
    assert cellscores.best_in_cell(pa.table(asked | {"k": pa.array([2], pa.int32())}).slice(0, 0), offered).num_rows == 0
