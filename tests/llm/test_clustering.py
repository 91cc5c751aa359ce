import hashlib
import math
from random import Random

import numpy as np
import pytest
from compare import connect, differences

from kinmatch.llm import clustering
from kinmatch.llm.queries import ORACLES, QUERIES


def brute(rows, k, rounds, size, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    return found, centroids


def got(df):
    return sorted(((str(r.vec_id), r.cluster, r.distance) for r in df.collect()))


def test_query_against_sql(spark, sf):
    assert differences(QUERIES["op13_clustering"](spark, sf), connect(sf), ORACLES["op13_clustering"]) == []


def test_against_brute_force(spark):
    rng = Random(5)
    rows = [(i, [rng.choice([0.0, 0.25, 1.0, -1.0, rng.uniform(-2, 2)]) for _ in range(4)]) for i in range(200)]
    rows += [(i % 7, v) for i, v in rows[:40]] + [(None, rows[3][1]), (None, [1.0] * 4), (300, None), (301, [1.0] * 3), (302, [1.0, None, 0.0, 0.0])]
    rows += [(303, [math.nan] * 4), (304, [math.inf] * 4), (305, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "2 AS distance").repartition(5)
    out = clustering.cluster(df, k=9, rounds=3, size=4, scale=256, seed=2)
    found, centroids = brute(rows, 9, 3, 4, 256, 2)
    assert got(out) == sorted((str(i), c, d) for i, c, d in found)
    for r in out.collect():
        assert r.inertia == sum(d for *_, d in found) and r.cluster_inertia == sum(d for _, c, d in found if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert clustering.cluster(spark.createDataFrame([], schema)).collect() == []
    one = clustering.cluster(spark.createDataFrame([(7, [0.5] * 64)], schema)).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(7, 0, 0, 0)]


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_search_is_exact_and_skips(scale):
    rng = np.random.default_rng(2)
    spots = rng.integers(-50, 50, (6, 8))
    rows = [[int(v * scale) for v in r] for r in np.repeat(spots, 100, axis=0) + rng.integers(-3, 4, (600, 8))]
    centroids = rows[::29]
    orchard = clustering.Orchard(centroids)
    x = clustering.integers(np.array(rows, float), 1)
    assert (x.dtype == object) == (scale > 1)
    at, best, looked = orchard.nearest(x)
    want = [min((sum((a - b) ** 2 for a, b in zip(r, c)), j) for j, c in enumerate(centroids)) for r in rows]
    assert list(zip(best.tolist(), at.tolist())) == want
    assert looked < 0.7 * len(rows) * len(centroids)


def test_distances_beyond_64_bits_end_the_job(spark):
    rows = [(i, [float(i) * 1e30] * 4) for i in range(4)]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        clustering.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2, rounds=1, size=4).collect()
