import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from kinmatch.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "\n", " \n x", "a", "'s", "''s", "it's 'twas we're they'll I'd 've 'r 'l '", "'re'r", "x'l", "x'r1", "a  b\t\tc \n", "a b  ",
       "<|endoftext|>", "a <|endoftext|>  b<|endoftext|><|endoftext|>", "=" * 3000, "z" * 2000, "日本語 テキスト", "é́ ﬁ ½ ²", "\U0001f600\U0001f600 \U0001f469‍\U0001f680",
       " " * 700 + "x", "　  x", "1 234 5'6", "don't" * 300, "\x00\x01 \x7f", "ꟋA\U0001e5d0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, texts):
    return [len(library.encode(x, add_special_tokens=False).ids) for x in texts]


def test_odd_texts(library):
    counter = token_counts.TokenCounter(PATH)
    assert counter.counts(ODD) == want(library, ODD)


@pytest.mark.parametrize(("chunk", "probe"), [(4, 2), (16, 3), (512, 16)])
def test_random_texts_at_small_chunks(library, monkeypatch, chunk, probe):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "PROBE", probe)
    rng = random.Random(chunk)
    texts = ["".join(rng.choice("  \n\tabstrevmld'''1.!é日") for _ in range(rng.randrange(0, 80))) for _ in range(1500)]
    assert token_counts.TokenCounter(PATH).counts(texts) == want(library, texts)


def test_whole_tables(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in token_counts.count_tokens(docs, PATH).collect()}
    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    counted = want(library, table["text"])
    for doc_id, text, n in zip(table["doc_id"], table["text"], counted, strict=True):
        assert (rows[doc_id].n_bytes, rows[doc_id].n_tokens) == (len(text.encode()), n)


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(str, token_counts.count_tokens(docs, PATH).collect()))
    assert got == sorted(map(str, [*[spark.createDataFrame([(1, 0, 0)], "doc_id long, n_bytes long, n_tokens long").first()] * 2,
                                   spark.createDataFrame([(None, 3, 2)], "doc_id long, n_bytes long, n_tokens long").first()]))
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []
