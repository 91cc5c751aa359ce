import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.functions import scorers
from kinmatch.operators import features
from kinmatch.params import FEATURES


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial(a, b):
    if not a or not b:
        return float(a == b)

    def best(s, t):
        m = len(s)
        windows = [t[i : i + m] for i in range(len(t) - m + 1)]
        windows += [t[:i] for i in range(1, m)] + [t[-i:] for i in range(1, m)]
        return max(ratio(s, w) for w in windows)

    s, t = sorted((a, b), key=len)
    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(s, t)


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not p or not q):
        return 1.0
    left, right = " ".join(filter(None, (both, p))), " ".join(filter(None, (both, q)))
    joined = 1 - (len(p) + len(q) - 2 * lcs(p, q)) / (len(left) + len(right))
    return max(joined, ratio(both, left), ratio(both, right)) if both else joined


def random_pairs(n, size, seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice("ab cdéह") for _ in range(rng.randint(0, rng.choice(size))))
    return [text() for _ in range(n)], [text() for _ in range(n)]


def test_lcs_against_table():
    a, b = random_pairs(400, (3, 20, 70, 300), 1)
    assert list(scorers.lcs_lengths(a, b)) == [lcs(x, y) for x, y in zip(a, b)]


def test_lcs_of_long_texts():
    a, b = random_pairs(4, (900,), 2)
    a, b = [x + "q" * 300 for x in a], [y + "qa" * 200 for y in b]
    assert list(scorers.lcs_lengths(a, b)) == [lcs(x, y) for x, y in zip(a, b)]


def test_partial_against_windows():
    a, b = random_pairs(250, (3, 12, 40, 75), 3)
    np.testing.assert_allclose(scorers.partial_ratios(a, b), [partial(x, y) for x, y in zip(a, b)], atol=1e-12)


def test_partial_of_long_texts():
    a, b = random_pairs(3, (60,), 4)
    a = [x + "q" * 280 for x in a]
    b = [y + "qa" * 150 for y in b]
    np.testing.assert_allclose(scorers.partial_ratios(a, b), [partial(x, y) for x, y in zip(a, b)], atol=1e-12)


def test_partial_of_long_texts_with_a_planted_window():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    short = text(260)
    a = [short, text(258)]
    b = [text(25) + short[:120] + "x" + short[130:] + text(20), text(258)]
    np.testing.assert_allclose(scorers.partial_ratios(a, b), [partial(x, y) for x, y in zip(a, b)], atol=1e-12)


def test_batches_are_cut_by_cells():
    sizes = [3, 4, 5, 900, 50_000, 2_000_000]
    cuts = list(scorers._cuts(sizes, 2, 60_000))
    assert [i for c in cuts for i in range(c.start, c.stop)] == list(range(len(sizes)))
    assert all(c.stop - c.start == 1 or (c.stop - c.start) * max(sizes[c]) <= 60_000 for c in cuts)
    a, b = random_pairs(40, (5, 200), 12)
    a, b = a + ["short"] * 2, b + ["s h o r t " * 20_000, "abc" * 50_000]
    for x, y, got in zip(a[-2:], b[-2:], scorers.lcs_lengths(a, b)[-2:]):
        assert got == lcs(x, y)


def test_one_exchange_with_python(spark):
    pairs = spark.createDataFrame([("a b", "b a", "c", "c d")], "nn1 string, nn2 string, na1 string, na2 string")
    plan = features.string_scores(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


GOLDEN = [
    ("kitten", "sitting", 0.615385, 0.615385, 0.615385, 0.666667),
    ("abc hosp 2", "abc hosp", 0.888889, 0.888889, 1, 1),
    ("red widget brand 17 corp", "widget red brand 17 trading", 0.666667, 0.784314, 0.883721, 0.739130),
    ("acme foods pvt ltd", "acme food ltd", 0.838710, 0.838710, 0.838710, 0.833333),
    ("alpha", "omega", 0.2, 0.2, 0.2, 0.333333),
    ("", "x", 0, 0, 0, 0),
    ("", "", 1, 1, 0, 1),
]


@pytest.fixture(scope="module")
def scored(spark):
    a, b = random_pairs(120, (4, 30), 5)
    rows = [(g[0], g[1]) for g in GOLDEN] + list(zip(map(str.strip, a), map(str.strip, b)))
    df = spark.createDataFrame([(i, *r, *r, "us", "us") for i, r in enumerate(rows)], "i int, nn1 string, nn2 string, na1 string, na2 string, cc1 string, cc2 string")
    out = features.add_features(df.withColumn("cosine", F.lit(None).cast("double")))
    return rows, out.orderBy("i").collect()


def test_golden_values(scored):
    _, got = scored
    for want, row in zip(GOLDEN, got):
        found = (row.name_ratio, row.name_token_sort, row.name_token_set, row.name_partial)
        assert found == pytest.approx(want[2:], abs=1e-6), want


def test_all_features_against_plain_python(scored):
    rows, got = scored
    for (a, b), r in zip(rows, got):
        x, y = set(a.split()), set(b.split())
        sorted_a, sorted_b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        jaccard = 1.0 if not x and not y else len(x & y) / len(x | y)
        assert r.name_ratio == pytest.approx(ratio(a, b))
        assert r.addr_ratio == r.name_ratio and r.addr_token_set == r.name_token_set
        assert r.name_token_sort == pytest.approx(ratio(sorted_a, sorted_b))
        assert r.name_token_set == pytest.approx(token_set(a, b)), (a, b)
        assert r.name_partial == pytest.approx(partial(a, b))
        assert r.name_jaccard == r.addr_jaccard == pytest.approx(jaccard)
        assert r.name_exact == r.addr_exact == float(a == b and a != "")
        assert r.common_name_tokens == r.common_addr_tokens == len(x & y)
        assert r.name_len_diff == r.addr_len_diff == abs(len(a) - len(b))
        assert r.country_exact == 1.0 and r.tfidf_cosine == 0.0


def test_raw_entry_normalises_first(spark):
    df = spark.createDataFrame(
        [("ABC Private Limited", "1 Main Road", " US", "abc pvt. ltd.", "1 main rd", "us")],
        "n1 string, a1 string, c1 string, n2 string, a2 string, c2 string",
    )
    row = features.pair_features_raw(df).first()
    assert (row.name_exact, row.addr_exact, row.country_exact, row.tfidf_cosine) == (1.0, 1.0, 1.0, 0.0)


def test_raw_records_are_normalised_once(spark):
    """Of whole records, the features of raw fields are those of pairs that carry the fields, without normalising per pair."""
    rows = [("S1-1", "ABC Private Limited", "1 Main Road", " US"), ("S2-1", "abc pvt. ltd.", "1 main rd", "us"), ("S2-2", None, "x & y", "India")]
    raw = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-3")], "s1_id string, c_id string")
    sides = [raw.toDF(key, f"n{n}", f"a{n}", f"c{n}") for n, key in ((1, "s1_id"), (2, "c_id"))]
    fields = pairs.join(sides[0], "s1_id").join(sides[1], "c_id")
    want = features.pair_features_raw(fields).select("s1_id", "c_id", *FEATURES).orderBy("c_id").collect()
    got = features.pair_features_raw(pairs, features.raw_records(raw))
    assert got.orderBy("c_id").collect() == want and len(want) == 2 and want[0].name_exact == 1.0


def test_texts_are_split_once_a_pair(spark):
    pairs = spark.createDataFrame([("a b", "b a", "c", "c d", "us", "us", 0.5)], "nn1 string, nn2 string, na1 string, na2 string, cc1 string, cc2 string, cosine double")
    plan = features.add_features(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 4 and plan.count("ArrowEvalPython") == 1


def test_windows_are_followed_only_where_they_may_win(monkeypatch):
    """Each pair takes a walk from the front and one from the back; windows between only while they may beat these."""
    followed, walk = [], scorers._window_lcs
    monkeypatch.setattr(scorers, "_window_lcs", lambda *a: followed.append(len(a[5])) or walk(*a))
    a = ["abcdefgh" * 3 + "x"] * 20 + ["qwer" * 5]
    b = ["abcdefgh" * 3 + "y" + "z" * 30] * 20 + ["zz" + "qwe_" * 5 + "z" * 9]
    np.testing.assert_allclose(scorers.partial_ratios(a, b), [partial(x, y) for x, y in zip(a, b)], atol=1e-12)
    assert sum(followed) < 40  # all starts of all pairs are 20 x 55 + 31


def test_letters_of_any_script():
    rng = random.Random(8)
    text = lambda: "".join(chr(rng.choice((97, 98, 0x4E00, 0x4E01, 0x10348, 0x1F600))) for _ in range(rng.randint(1, 130)))
    a, b = [text() for _ in range(60)], [text() for _ in range(60)]
    assert list(scorers.lcs_lengths(a, b)) == [lcs(x, y) for x, y in zip(a, b)]
    np.testing.assert_allclose(scorers.partial_ratios(a[:25], b[:25]), [partial(x, y) for x, y in zip(a, b)][:25], atol=1e-12)


def test_udfs_by_name(spark):
    scorers.register(spark)
    row = spark.sql("SELECT lcs_length('kitten', 'sitting') AS a, partial_ratio('abc', 'xabcx') AS b").first()
    assert (row.a, row.b) == (4, 1.0)
