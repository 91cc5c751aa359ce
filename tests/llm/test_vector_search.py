import numpy as np
import pytest
from compare import connect, differences

from kinmatch.llm import vector_search
from kinmatch.llm.common import stage
from kinmatch.llm.queries import ORACLES, QUERIES


def brute(rows, asked, k):
    out = []
    for q, v in asked.items():
        scores = sorted((-int(np.dot(v, w)), i) for i, w in rows.items() if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 8192), (50, 3)])
def test_search(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_search, "CANDIDATES", blocks[0])
    monkeypatch.setattr(vector_search, "QUERIES", blocks[1])
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (400, 24)).astype(np.float32)
    x[100:200] = x[7]  # a third alike, many ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 0), (901, [1.0, None] * 12, 0), (902, [float("nan")] * 24, 0), (903, [float("inf")] * 24, 0), (904, [], 0), (905, [1.0, 2.0], 0), (None, [1.0] * 24, 0), (5, x[5].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    q = vector_search.quantised(df)
    assert sorted(r.vec_id for r in q.collect()) == sorted([*range(400), 5, 905])  # the repeated row is one of its own
    q = q.dropDuplicates(["vec_id"])
    kept = {r.vec_id: r.v for r in q.collect()}
    assert sorted(kept) == [*range(400), 905]
    assert all(kept[i] == np.floor(1024 * x[i].astype(float)).astype(int).tolist() for i in range(400))
    got = vector_search.top_k(q, q.where("vec_id % 50 = 0 OR vec_id IN (110, 905)"), 10)
    asked = {i: v for i, v in kept.items() if i % 50 == 0 or i in (110, 905)}
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute(kept, asked, 10)
    assert vector_search.top_k(q.limit(0), q.limit(0)).collect() == []


def brute_rows(rows, asked, k):
    """All rows against all rows, none folded."""
    out = {}
    for q, v in asked:
        out.setdefault(q, []).extend((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
    return sorted((q, n + 1, i, -s) for q, found in out.items() for n, (s, i) in enumerate(sorted(found)[:k]))


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("blocks", [4096, 7])
def test_repeated_ids_are_rows_of_their_own(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_search, "CANDIDATES", blocks)
    rng = np.random.default_rng(3)
    rows = [(0, [1, 1]), (1, [5, 0]), (1, [9, 0]), (1, [9, 0]), (2, [3, 3]), (100, [2, -1]), (100, [-4, 7])]
    rows += [(int(i), rng.integers(-9, 9, 2).tolist()) for i in rng.integers(3, 30, 60)]
    df = stage(spark.createDataFrame(rows, "vec_id long, v array<long>"), "rows")
    got = found(vector_search.top_k(df, df.where("vec_id % 100 = 0"), 10))
    assert got == brute_rows(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert sum(r[2] == 1 and r[3] == 9 for r in got if r[0] == 0) == 2


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    rows = [(0, [big, big]), (1, [big, -big]), (2, [big, 1 - big]), (3, [-big, -big]), (4, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    # the sum of two products fits although the bound does not
    assert found(vector_search.top_k(df, df.where("vec_id = 4"), 10)) == brute_rows(rows, [rows[4]], 10)
    near = df.where("vec_id IN (0, 1, 2, 4)")
    assert found(vector_search.top_k(near, df.where("vec_id = 0"), 10)) == brute_rows([r for r in rows if r[0] != 3], [rows[0]], 10)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        vector_search.top_k(df, df.where("vec_id = 0"), 10).collect()
    wide = spark.createDataFrame([(0, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        vector_search.quantised(wide).collect()


def test_query_against_sql(spark, sf):
    assert differences(QUERIES["op4_vector_search"](spark, sf), connect(sf), ORACLES["op4_vector_search"]) == []
