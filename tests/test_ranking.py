import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import ranking


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randint(0, 5)}", rng.randint(0, 40), f"id{i}", i) for i in range(2000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v int, id string, ord long").repartition(7).cache()
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return df, groups


@pytest.mark.parametrize("n", [0, 1, 37, 400, 5000])
def test_first_n(rows, n):
    df, groups = rows
    df = df.withColumn("b", ranking.spread_bucket(ranking.spread("id")))
    got = ranking.first_n(df, ["g"], ["v", "b"], [ranking.spread("id"), F.col("id")], F.lit(n))
    import hashlib

    want = {
        r[2]
        for group in groups.values()
        for r in sorted(group, key=lambda r: (r[1], hashlib.md5(r[2].encode()).hexdigest()))[:n]
    }
    found = [r.id for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_first_n_without_group(rows):
    df, groups = rows
    got = ranking.first_n(df, [], ["v"], [F.col("id")], F.lit(100))
    want = sorted((r for g in groups.values() for r in g), key=lambda r: (r[1], r[2]))[:100]
    assert {r.id for r in got.collect()} == {r[2] for r in want}


def test_ordinal_and_range(rows):
    df, groups = rows
    df = df.withColumn("block", F.floor(F.col("ord") / 64))
    want = {r[2]: at for g in groups.values() for at, r in enumerate(sorted(g, key=lambda r: r[3]))}
    numbered = ranking.ordinal(df, ["g"], "block", [F.col("ord")], "at")
    assert {r.id: r["at"] for r in numbered.collect()} == want
    for start, end in ((0, 10), (50, 130), (900, 2000), (5000, 6000)):
        part = ranking.row_range(df, ["g"], "block", [F.col("ord")], start, end)
        assert {r.id for r in part.collect()} == {i for i, at in want.items() if start <= at < end}
