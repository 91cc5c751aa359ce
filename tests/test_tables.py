import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kinmatch.operators import features, inference
from kinmatch.sources import tables

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


@pytest.fixture()
def source(tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text(
        HEAD + 'S1-1\t"q ""x"" y"\t1, Main Road\tUS\n' + "S1-2\tNA\t\tIndia\n" + "S1-3\tहिन्दी\\n\t2 Rd\t\n", encoding="utf-8"
    )
    return str(path)


def test_read_source(spark, source):
    rows = tables.read_source(spark, source).orderBy("ord").drop("ord").collect()
    assert [tuple(r) for r in rows] == [
        ("S1-1", 'q "x" y', "1, Main Road", "US"),
        ("S1-2", "NA", "", "India"),
        ("S1-3", "हिन्दी\\n", "2 Rd", ""),
    ]
    assert [r.entity_id for r in tables.read_source(spark, source, nrows=2).collect()] == ["S1-1", "S1-2"]


def test_records(spark, source):
    rows = tables.records(tables.read_source(spark, source)).orderBy("ord").collect()
    assert [(r.src, r.nn, r.na, r.cc) for r in rows][:2] == [(1, "q x y", "1 main rd", "us"), (1, "na", "", "india")]


def test_source_round_trip(spark, source, tmp_path):
    first = tables.read_source(spark, source)
    tables.write_tsv(first, str(tmp_path / "copy"), "ord")
    again = tables.read_source(spark, str(tmp_path / "copy"))
    assert [tuple(r)[:4] for r in again.orderBy("ord").collect()] == [tuple(r)[:4] for r in first.orderBy("ord").collect()]


def test_source_ids(spark, tmp_path):
    path = tmp_path / "ids.tsv"
    path.write_text(HEAD + " S2-1 \tx\n\n   \nS2-2\nS2-1\ty\n")
    assert sorted(r[0] for r in tables.source_ids(spark, str(path)).collect()) == ["S2-1", "S2-2"]


def test_ground_truth(spark):
    links = spark.createDataFrame(
        [(1, " S1-1", "S2-1, S2-1 ,,S3-1"), (2, "S1-2", " "), (3, "S1-1", "S2-9")], "ord int, source1_entity_id string, matched_entity_ids string"
    )
    got = {r.s1_id: r.truth for r in tables.ground_truth(links, "ord").collect()}
    assert got == {"S1-1": ["S2-9"], "S1-2": []}
    wanted = spark.createDataFrame([("S1-1",), ("S1-7",)], "s1_id string")
    some = tables.ground_truth_of(tables.ground_truth(links.where("ord < 3")), wanted)
    assert {r.s1_id: sorted(r.truth) for r in some.collect()} == {"S1-1": ["S2-1", "S3-1"], "S1-7": []}


@pytest.fixture()
def s1(spark):
    return spark.createDataFrame([(f"S1-{i}", "us" if i % 2 else "fr", i) for i in range(6)], "entity_id string, cc string, ord int")


def test_links_round_trip(spark, s1, tmp_path):
    pairs = spark.createDataFrame([("S1-3", "S3-9", 2), ("S1-3", "S2-4", 1), ("S1-0", "S2-1", 1)], "s1_id string, c_id string, pos int")
    lists = tables.candidate_lists(s1, pairs)
    path = str(tmp_path / "c")
    tables.write_links(lists, path)
    text = spark.read.text(path)
    assert text.where("value = 'S1-1\t'").count() == 1 and text.where(F.contains("value", F.lit('"'))).count() == 0
    back = tables.read_links(spark, path, tables.CANDIDATE_COLUMNS)
    assert [r[0] for r in back.orderBy("ord").collect()] == [f"S1-{i}" for i in range(6)]
    stored = tables.explode_lists(back, s1.where("cc = 'us'"))
    assert sorted(tuple(r) for r in stored.collect()) == [("S1-3", "S2-4", 1), ("S1-3", "S3-9", 2)]


def test_parts(spark, s1, tmp_path):
    path = str(tmp_path / "parts")
    lists = tables.link_lists(s1, spark.createDataFrame([("S1-3", "S2-4", 1)], "s1_id string, c_id string, pos int"))
    placed = lists.join(s1.select(F.col("entity_id").alias("source1_entity_id"), "cc"), "source1_entity_id").withColumn("part", F.lit(0))
    tables.write_parts(placed, path)
    tables.write_parts(placed.where("cc = 'us'").withColumn("matched_entity_ids", F.lit("S2-7")), path)
    parts = spark.read.parquet(path).withColumn("part_id", F.col("part"))
    merged = {r[0]: r[1] for r in tables.merge_complete(s1, parts).select("source1_entity_id", "matched_entity_ids").collect()}
    assert merged == {f"S1-{i}": "S2-7" if i % 2 else "" for i in range(6)}
    some = parts.where("cc = 'us'")
    assert tables.missing_parts(tables.merge_parts(s1, some)).count() == 3
    with pytest.raises(ValueError):
        tables.merge_complete(s1, some)
    counted = Observation()
    assert len(tables.merge_parts(s1, some, missing=counted).collect()) == 6
    assert counted.get == {"n_missing": 3, "n_empty": 3}


def test_slice(s1):
    by_ten = F.floor(F.col("ord") / 2)
    assert [r.entity_id for r in inference.slice_s1(s1, "us", 1, 3, by_ten).orderBy("ord").collect()] == ["S1-3", "S1-5"]
    assert inference.slice_s1(s1, "us", 3, 9, by_ten).count() == 0


def test_slice_by_file_block(spark, source):
    records = tables.records(tables.read_source(spark, source)).withColumn("cc", F.lit("x"))
    assert [r.entity_id for r in inference.slice_s1(records, "x", 1, 2).collect()] == ["S1-2"]


def test_unresolved_pairs_are_counted_in_the_same_job(spark):
    s1 = spark.createDataFrame([("S1-1", "a b", "", "us")], "entity_id string, nn string, na string, cc string")
    s23 = spark.createDataFrame([("S2-1", "a b", "x", "us")], "entity_id string, nn string, na string, cc string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-9"), ("S1-7", "S2-1")], "s1_id string, c_id string")
    counted = Observation()
    found = features.pair_features(pairs, s1, s23, strict=False, unresolved=counted)
    assert [(r.s1_id, r.c_id, r.name_exact) for r in found.collect()] == [("S1-1", "S2-1", 1.0)]
    assert counted.get == {"n_unresolved": 2}
    with pytest.raises(Exception, match="no record for"):
        features.pair_features(pairs, s1, s23).collect()
