import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinmatch.llm import packing
from kinmatch.llm.queries import QUERIES
from kinmatch.llm.token_counts import WordCounter

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a<|endoftext|>b<|endoftext|>", "<|endoftext|>", " " * 1_000_003 + "a", "aé٣ 日本 '", "　 x y\u0085​", "👩‍👩‍👧 x'll I've 'S",
    "", "x" * 30_000, "\U00010d4e\U0001e4d0a1 \U0001f9ffa", "a�͸b",
]


def test_ids_are_the_librarys(spark, sf):
    library, encode = Tokenizer.from_file(PATH), packing.encoder(PATH).encode
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text in texts + ODD:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_word_of_the_vocabulary_comes_from_its_listed_merge():
    # then merging by the rank of the result and merging by listed pairs are the same
    counter = WordCounter(PATH)
    words = {a + b for a, b in counter.ranks}
    assert len(words) == len(counter.ranks)
    assert all(counter.merged(w) == [w] for w in words)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    size = 64
    histogram = dict(Counter(rng.choice([rng.randint(1, size), 5, size]) for _ in range(rng.choice([0, 1, 3000]))))
    plan = packing.shortest_pack_first(histogram, size)
    filled, ranks = {}, {}
    for length, low, count, sequence, offset in plan.slots:
        ranks.setdefault(length, []).extend(range(low, low + count))
        for s in range(sequence, sequence + count):
            filled.setdefault(s, []).append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert sorted(filled) == list(range(plan.sequences))
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    assert Counter(tuple(n for _, n in sorted(x)) for x in filled.values()) == sum((Counter({p: n}) for p, n in plan.patterns), Counter())
    assert len(plan.patterns) <= 3 * size


def test_shortest_pack_takes_the_next_piece():
    # 6 opens a pack, then 5 does; 3 goes to the pack of 5, the shorter one, and 2 to the pack of 6
    plan = packing.shortest_pack_first({6: 1, 5: 1, 3: 1, 2: 1}, 10)
    assert dict(plan.patterns) == {(6, 2): 1, (5, 3): 1}
    # pieces of one length share packs
    assert dict(packing.shortest_pack_first({3: 100}, 10).patterns) == {(3, 3, 3): 33, (3,): 1}


def checked(rows, texts, size, end):
    """``rows`` (doc_id, start, length, crc, doc_tokens, sequence_id, offset) against the library's ids of each doc_id's text."""
    library, by_doc, by_sequence = Tokenizer.from_file(PATH), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, parts in by_doc.items():
        ids, at = [*library.encode(texts[doc_id], add_special_tokens=False).ids, end], 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return by_sequence


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op11_packing"](spark, sf).collect()
    by_sequence = checked(rows, {r.doc_id: r.text or "" for r in docs.collect()}, 1024, 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(r.length for r in rows) > 0.9 * 1024 * len(by_sequence)


def test_ids_lie_where_the_slots_say(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)  # many chunks a file
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["one", "two", "Ünder", "日本"]) for _ in range(rng.choice([0, 1, 3, 3, 3, 60]))) for i in range(300)}
    docs = spark.createDataFrame([(i, t or None) for i, t in texts.items()], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS length", "2 AS rank", "3 AS sequence_id").repartition(5)
    packed = packing.pack(docs, PATH, size=16, end=50256, with_ids=True)
    rows = packed.collect()
    by_sequence = checked(rows, texts, 16, 50256)
    for r in packing.sequences(packed, 16, 50256).collect():
        parts = sorted(by_sequence[r.sequence_id], key=lambda x: x.offset)
        ids = b"".join(bytes(x.ids) for x in parts)
        n = len(ids) // 4
        full = n if n & (n - 1) == 0 else 16
        assert r.n_tokens == n and bytes(r.ids) == ids + np.full(full - n, 50256, "<u4").tobytes()


def test_odd_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, PATH).collect() == []
    rows = [(None, "a b"), (None, "a b"), (1, None), (1, ""), (1, "a b")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == [("1", 1), ("1", 1), ("1", 3), ("None", 3), ("None", 3)]
    assert {r.sequence_id for r in got} == {0} and sorted(r.offset for r in got) == [0, 3, 6, 9, 10]
