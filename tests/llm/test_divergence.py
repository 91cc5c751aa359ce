import re
from collections import Counter, defaultdict
from random import Random

from compare import connect, differences

from kinmatch.llm import divergence
from kinmatch.llm.queries import ORACLES, QUERIES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        counts[lang or "", source or ""].update(words := TERM.findall(lowered))
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g for g, _ in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}

        def shares(c):
            below = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // below for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        share = {s: shares(c) for s, c in groups.items()}
        whole = shares({t: sum(c[t] for c in groups.values()) for t in kept})
        for s in groups:
            pairs = [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(share[s][t], whole[t])) for t in kept if groups[s][t] and share[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(ordered)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_query_against_sql(spark, sf):
    assert differences(QUERIES["op12_divergence"](spark, sf), connect(sf), ORACLES["op12_divergence"]) == []


def test_cells_against_brute_force(spark, monkeypatch):
    rng, words = Random(3), ["a", "B", "é", "Éa", "日本", "x9y", "", "z z", "q"]
    rows = [(" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40]))), rng.choice(["en", None, "fr"]), rng.choice([*"stuvwxy", None])) for _ in range(200)]
    rows += [(None, "de", "s"), ("", "de", "t"), ("once", "de", "u"), ("alone " * 20, "it", "s"), ("word " * 30000, "en", "s"), ("w" * 100000, "en", "t")] * 2
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "text string, lang string, source string, term string, n int")
    monkeypatch.setattr(divergence, "HELD", 10)
    assert got(divergence.audit(docs, 3, 4, groups=3, terms=2)) == brute(rows, 3, 4)
    assert got(divergence.audit(docs, 3, 4)) == brute(rows, 3, 4)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_large_counts_stay_exact(spark):
    """Shares of counts beyond 64 bits' reach once multiplied by the unit."""
    df = spark.createDataFrame([(10**15 + 7, 3 * 10**15, 11)], "n long, total long, terms long")
    share = df.select(divergence._share(df.n, "total", "terms").alias("p")).first().p
    assert share == 1 + 10**9 * (10**15 + 9) // (3 * 10**15 + 22)
