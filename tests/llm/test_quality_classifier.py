import zlib

import numpy as np

from kinmatch.llm import quality


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    model = quality.train(docs, labels.where(~quality.held_out()))
    label = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.score(docs, model).collect() if r.doc_id in label and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) > 500
    assert np.mean([(r.score >= 0.7) == label[r.doc_id] for r in rows]) > 0.98


def test_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(0)
    params = quality.Params(buckets=12, epochs=400)
    rows = [np.flatnonzero(rng.random(12) < 0.5).astype(np.int32) for _ in range(60)]
    labels = np.array([int(3 in r) if rng.random() < 0.9 else 0 for r in rows])
    ratio = quality.log_count_ratio(rows, labels, params)
    weights = quality.descend(rows, labels, ratio, params)
    share = np.array([(labels == c).mean() for c in (0, 1)])
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / max(np.linalg.norm(ratio[r]), 1e-9)
    x[:, 12] = 1
    y, caps = np.where(labels == 1, 1, -1), 0.5 / share[labels]
    loss = lambda w: w @ w / 2 + (caps * np.maximum(0, 1 - y * (x @ w))).sum()
    assert all(loss(weights) <= loss(weights + d) + 1e-3 for d in rng.normal(0, 0.05, (300, 13)))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (1, None, 9.0), (None, "x", 1.0), (2, "y" * 200000, 1.0)], "doc_id long, text string, score double")
    none = docs.selectExpr("doc_id", "1 AS quality").limit(0)
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    one = docs.selectExpr("doc_id", "1 AS quality")
    assert all(r.score > 0.5 for r in quality.score(docs, quality.train(docs, one)).collect())
    assert quality.score(docs.limit(0), quality.train(docs, one)).collect() == []
