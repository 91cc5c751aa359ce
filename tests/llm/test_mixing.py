import numpy as np
import pytest

from kinmatch.llm import mixing


def test_rates_meet_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labelled = docs.selectExpr("doc_id", "lang AS domain")
    params = mixing.Params(targets={"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2})
    rows = mixing.mix(docs, labelled, params).collect()
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(langs[r.doc_id] == r.domain for r in rows) >= 0.95 * len(rows)
    n, p, rate = (np.array([getattr(r, c) for r in rows]) for c in ("n_tokens", "posterior", "rate"))
    assert rate.min() >= 0 and np.allclose(p.sum(axis=1), 1)
    shares = (n * rate) @ p / n.sum()
    assert np.abs(shares - [0.2, 0.4, 0.2, 0.2]).max() < 1e-3  # de, en, es, fr
    whole = np.floor(rate)
    copies = np.array([r.copies for r in rows])
    assert ((copies == whole) | (copies == whole + 1)).all()
    assert abs(copies.mean() - rate.mean()) < 0.1


def test_rates_against_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    n = rng.integers(1, 500, 300)
    params = mixing.Params(targets={"a": 0.9, "b": 0.08, "c": 0.02}, tolerance=1e-6)
    soft = spark.createDataFrame([(i, int(n[i]), p[i].tolist()) for i in range(300)], "doc_id long, n_tokens long, p array<double>")
    rate = np.array([r.rate for r in mixing.fit_rates(soft, ["a", "b", "c"], params).orderBy("doc_id").collect()])
    a = p * (n / n.sum())[:, None]
    wanted = np.array([0.9, 0.08, 0.02])
    plain = np.ones(300)
    for _ in range(20000):
        plain = np.maximum(0, plain - (p @ (plain @ a - wanted)))
    assert np.abs(plain @ a - wanted).max() < 1e-4
    assert rate.min() >= 0 and np.abs(rate @ a - wanted).max() < 1e-4


def test_odd_rows(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (None, None, "y"), (2, "", "z"), (3, "der hund " * 20000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    labelled = spark.createDataFrame([(1, "en"), (3, "de"), (None, "fr"), (2, None)], "doc_id long, domain string")
    got = mixing.mix(docs, labelled).collect()
    assert len(got) == 5 and {r.domain for r in got if r.doc_id in (1, 3)} == {"en", "de"}
    none = mixing.mix(docs, labelled.limit(0)).collect()
    assert [(r.rate, r.copies, r.domain) for r in none] == [(1.0, 1, None)] * 5
    assert mixing.mix(docs.limit(0), labelled).collect() == []
    assert mixing.mixed(docs, labelled).columns == docs.columns


def test_targets_are_checked(spark):
    soft = spark.createDataFrame([(1, 5, [1.0])], "doc_id long, n_tokens long, p array<double>")
    with pytest.raises(ValueError):
        mixing.fit_rates(soft, ["a"], mixing.Params(targets={"b": 1.0}))
