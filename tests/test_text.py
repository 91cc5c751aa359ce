import pytest
from pyspark.sql import functions as F

from kinmatch.functions import text as tx

CASES = [
    (None, "", ""),
    ("Smith & Sons", "smith and sons", "smith and sons"),
    ("ABC Private Limited", "abc pvt ltd", "abc pvt ltd"),
    ("ABC Pvt. Ltd.", "abc pvt ltd", "abc pvt ltd"),
    ("ABC Hospital 2", "abc hosp 2", "abc hosp 2"),
    ("Main Road’s", "main rd’s", "main road’s"),
    ("one two", "one two", "one two"),
    ("हिन्दी Road", "हिन्दी rd", "हिन्दी rd"),
    ("NA", "na", "na"),
    ("  (A)-[B]_{C}  ", "a b c", "a b c"),
    ("roadx 9road road_road", "roadx 9road rd rd", "roadx 9road rd rd"),
    ("...", "", ""),
]


def test_normalize(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, s string").select(
        "i", tx.normalize(F.col("s")).alias("edge"), tx.normalize_tokens(F.col("s")).alias("token")
    )
    got = {r.i: (r.edge, r.token) for r in rows.collect()}
    assert got == {i: (c[1], c[2]) for i, c in enumerate(CASES)}


def test_normalize_is_idempotent(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "s string").select(tx.normalize_tokens(F.col("s")).alias("a"))
    assert all(r.a == r.b for r in rows.select("a", tx.normalize_tokens(F.col("a")).alias("b")).collect())


def test_country(spark):
    raw = [(None,), ("  India\t",), ("",), ("İX",)]
    got = [r[0] for r in spark.createDataFrame(raw, "s string").select(tx.normalize_country(F.col("s"))).collect()]
    assert got[:3] == ["", "india", ""]


@pytest.mark.parametrize(
    "text,analyzer,want",
    [
        ("acme a foods ltd", "word", ["acme", "foods", "ltd", "acme foods", "foods ltd"]),
        ("acme", "word", ["acme"]),
        ("a b", "word", []),
        ("", "word", []),
        ("हिन्दी rd", "word", ["rd"]),
        ("ab c", "char", [" ab", "ab ", " c "]),
        ("", "char", []),
    ],
)
def test_terms(spark, text, analyzer, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert sorted(r.term for r in tx.explode_terms(df, [], "t", analyzer).collect()) == sorted(want)


def test_blocking_texts(spark):
    rows = [("n", "a"), ("n", ""), ("", "a"), ("", "")]
    df = spark.createDataFrame(rows, "nn string, na string").select(
        tx.blocking_text(F.col("nn"), F.col("na")), tx.blocking_text_column(F.col("nn"), F.col("na"))
    )
    assert [tuple(r) for r in df.collect()] == [("n n a", "n n a"), ("n", "n n"), ("a", "a"), ("", "")]
