"""The bitmap that spares rows a shuffle: no key is missed, and few others are taken for one."""

from pyspark.sql import functions as F

from kinmatch.llm import common
from kinmatch.session import stage


def test_no_key_is_missed(spark):
    rows = spark.range(20000).select(F.struct(F.lit("f").alias("file"), "id").alias("k"), F.col("id").alias("_kept"))
    keys = stage(rows.where("_kept % 7 = 3").select("k"), "keys")
    maybe, rest = common.split_by(rows, keys, "k")
    assert maybe.columns == rest.columns == rows.columns
    found, other = ({r[0] for r in part.select("_kept").collect()} for part in (maybe, rest))
    hit = {i for i in range(20000) if i % 7 == 3}
    assert hit <= found and not found & other and len(found | other) == 20000
    assert len(found - hit) < 0.04 * (20000 - len(hit))  # a bit in 32 at most is set
    assert {r[0] for r in common.without(rows, keys, "k").select("_kept").collect()} == set(range(20000)) - hit


def test_full_bitmap_and_odd_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_BLOCKS", 1)
    rows = spark.range(200_000).select("id")
    keys = stage(spark.range(0, 200_000, 2).select("id"), "keys")
    assert common.without(rows, keys, "id").count() == 100_000
    odd = spark.createDataFrame([(None,), (1,), (1,), (2,)], "id long")
    no_keys = stage(odd.limit(0), "keys")
    assert common.without(odd, no_keys, "id").count() == 4
    assert common.without(odd.limit(0), keys, "id").count() == 0
    one = stage(odd.where("id = 1"), "keys")
    assert sorted(common.without(odd, one, "id").collect(), key=str) == sorted([(2,), (None,)], key=str)
