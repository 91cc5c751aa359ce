import corpus_pipeline

from kinmatch.llm import simhash


def test_near_copies_stay_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = [(90001, None), (90002, ""), (90003, "one two"), (None, "One two"), (90003, "one two"), (90004, "x " * 50000)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("*", "1 AS fp", "2 AS component_id")
    groups = simhash.near_duplicate_groups(docs.select("doc_id", "text")).collect()
    stays = simhash.without_near_copies(docs)
    assert stays.columns == docs.columns
    assert sorted(r.doc_id for r in stays.collect()) == sorted({r.component_id for r in groups})


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, sf), "t")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() == docs.count()
