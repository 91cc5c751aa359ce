"""SentencePiece encoding and decoding over a table of distinct marked words.

When no piece of a model holds a white-space marker after another character, no piece crosses from
one marked word (markers, then other characters) to the next, and a text's ids are those of its
marked words one after another. Each task keeps a table of the words that it has met, has the
library segment each distinct word once, and joins the ids back by position.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from kinmatch.llm.common import per_batch, text_or_empty

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
CROSSING = re.compile(f"[^{MARK}]{MARK}")
#: Words that a task's table holds at most; then it starts anew. Longer words are not kept in it.
TABLE_WORDS = 300_000
WORD_CHARS = 64


class WordTable:
    def __init__(self, path: str, limit: int = TABLE_WORDS) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("the model changes texts before it marks words")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(CROSSING.search(p.piece) for p in proto.pieces):
            raise ValueError("pieces of this model cross white-space markers")
        if any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are matched before words are marked")
        self.mark = [self.library.piece_to_id(MARK)]
        self.limit = limit
        self.ids: dict[str, list[int]] = {}

    def words(self, text: str) -> list[str]:
        return WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of each marked word. The library puts the first marker back itself."""
        bare = [w[1:].replace(MARK, " ") for w in words]
        return [i if b else self.mark for i, b in zip(self.library.encode(bare, num_threads=1), bare, strict=True)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.words(x) for x in texts]
        new = list(set(chain.from_iterable(split)).difference(self.ids))
        if len(self.ids) + len(new) > self.limit:
            self.ids.clear()
            new = list(set(chain.from_iterable(split)))
        own = dict(zip(new, self.segment(new), strict=True))
        of = self.ids | own if len(own) > self.limit else self.ids
        if of is self.ids:
            of.update(own)
        out = [list(chain.from_iterable(map(of.__getitem__, words))) for words in split]
        for word in own:
            if len(word) > WORD_CHARS:
                self.ids.pop(word, None)
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids) if ids else []


@lru_cache(maxsize=2)
def word_table(path: str) -> WordTable:
    return WordTable(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs`` (doc_id, text, ...).

    ``ids`` are the library's for the whole text, without begin and end; ``decoded`` is its decoding
    of them. Null text counts as empty and gives no ids and the empty text; repeated rows and null
    doc_ids come back as they are; extra columns are ignored. ``model`` is a path that every
    executor has.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = word_table(model)
        ids = table.encode(batch.column(1).to_pylist())
        out = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(table.decode(ids), pa.string())]
        return pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return per_batch(slim, run, "doc_id long, ids array<int>, decoded string")
