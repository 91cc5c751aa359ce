import numpy as np
import pytest
import xxhash

from kinmatch.llm import simhash


def brute(rows, words, threshold):
    prints = {}
    for doc_id, text in rows:
        w = simhash.WORD.findall((text or "").translate(simhash.LOWER))
        sh = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        prints[doc_id] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    return prints, closure(prints, threshold)


def closure(prints, threshold):
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_groups_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    extra = [(90001, None), (90002, ""), (90003, " \t"), (90004, "One"), (90005, "one"), (90006, "x " * 50000), (90007, "x " * 50000)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    docs = docs.selectExpr("*", "1 AS fp", "2 AS component_id")
    prints, roots = brute(rows + extra, 3, 2)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicate_groups(docs).collect()}
    assert got == {k: (prints[k], roots[k]) for k in prints}


@pytest.mark.parametrize(("threshold", "cell_rows"), [(2, 4096), (2, 8), (2, 100), (1, 4096), (3, 20), (0, 4096)])
def test_links_of_dense_clusters(spark, threshold, cell_rows):
    rng = np.random.default_rng(threshold)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = set()
    for c in centres.tolist():
        for _ in range(150):
            x = c
            for bit in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << bit
            values.add(x)
    values = sorted(values)
    prints = {i: v for i, v in enumerate(values)}
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    from kinmatch.llm.common import components

    nodes = dict(signed)
    of = {r.node: r.root for r in components(simhash.links(df, threshold, cell_rows), "t").collect()}
    want = closure(prints, threshold)
    groups = {}
    for i, v in nodes.items():
        groups.setdefault(of.get(v, v), set()).add(i)
    wanted = {}
    for i, r in want.items():
        wanted.setdefault(r, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_every_word_has_one_home():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    row, _, home = simhash.anchors(x, 2)
    assert sorted(row[home]) == list(range(1000))


def test_empty_table_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicate_groups(empty).collect() == []
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "zz yy xx")]
    got = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("1", "1"), ("1", "1"), ("None", "1"), ("None", "None")]
