import hashlib
import re

from pyspark.sql import functions as F

from kinmatch.llm import exact_dedup

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (3, "a\n\nb"), (None, "a b"), (None, None), (7, ""), (8, None), (None, "z"), (None, "z"), (1, "x " * 50000), (2, "x\t" * 50000)]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def check(found, rows):
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == sorted((x[:3] for x in expected(rows)), key=str)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({x[3] for x in expected(rows)}) and all(r.doc_id == r.keep_id for r in kept)


def test_groups(spark):
    docs = spark.createDataFrame([(*r, 1, "q") for r in ROWS], "doc_id long, text string, digest int, n string").repartition(3)
    found = exact_dedup.exact_duplicates(docs)
    check(found, ROWS)
    assert {r.digest.hex() for r in found.collect()} == {x[3] for x in expected(ROWS)}
    kept = exact_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 4


def test_digest_clashes_are_told_apart_by_bytes(spark):
    weak = lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1))
    rows = [(i, f"text {i % 40}") for i in range(120)] + ROWS
    check(exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), weak), rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(docs).collect() == []
    assert exact_dedup.without_duplicates(docs).collect() == []
