import public_tokenizers
import pytest
import sentencepiece

from kinmatch.llm import sentencepieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a ", "a  ", " a", "a  b\n c", "▁a▁▁b▁", "<s>hi</s>", "\x00", "日本語　テキスト", "\U0001f600 x", "x" * 30000, "a b " * 9000, "\n\n  \t x", "é́"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("limit", [3, 300_000])
def test_odd_texts(library, limit):
    table = sentencepieces.WordTable(PATH, limit)
    for _ in range(2):
        ids = table.encode(ODD)
        assert ids == library.encode(ODD)
        assert table.decode(ids) == [library.decode(i) for i in ids]


def test_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 AS ids")
    want = {r.doc_id: library.encode(r.text or "") for r in docs.collect()}
    got = sentencepieces.encode(docs, PATH).collect()
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.decoded == library.decode(want[r.doc_id]) for r in got)


def test_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a")], "doc_id long, text string")
    assert sorted((str(r.doc_id), len(r.ids), r.decoded) for r in sentencepieces.encode(docs, PATH).collect()) == [("1", 0, ""), ("1", 0, ""), ("None", 1, "a")]
    assert sentencepieces.encode(docs.limit(0), PATH).collect() == []
