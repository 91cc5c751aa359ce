"""Packing documents into sequences: shortest pack first over the histogram of lengths.

Every document becomes token ids and an end mark, cut into full sequences and one rest. The histogram
of the lengths (one row a length, however many documents there are) is packed longest first: pieces of
a length go to the open packs with the most room, all packs of a pattern at once, and a pattern's
count is split where pieces run out. That gives slots: ranks of a length, the sequences that they go
to and the offset there. Pieces are numbered within their length and find their slot by rank.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from kinmatch.llm.common import arrow_settings, per_batch, stage, text_or_empty
from kinmatch.llm.token_counts import LETTER, NUMBER, OTHER, QUOTE, WordSplitter

#: Tokens of a sequence, and the id that ends a document and fills a sequence up.
SIZE = 1024
END = 0
#: Rows of a file of pieces that are numbered together.
CHUNK = 1 << 16
#: How byte-level tokenizers cut a text into words (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids exactly as the library gives them, without added tokens; strings of added tokens inside a text are these tokens.

    A byte-level tokenizer's merges are applied by a faster library with the same words and ranks.
    The two can only differ on characters that they put in different classes, which is looked up for
    each character met; such texts, and those that the faster one refuses, go to the library itself.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        described = json.loads(self.library.to_str())
        pre, model, added = described["pre_tokenizer"] or {}, described["model"], described["added_tokens"]
        if described["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE tokenizer")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens with conditions")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.added = {t["content"]: t["id"] for t in added}
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        order = {piece: rank for rank, piece in enumerate([*byte_of, *merged])}
        ranks = {bytes(byte_of[c] for c in piece): order[piece] for piece in model["vocab"] if piece not in self.added}
        self.ids = np.empty(len(order), np.uint32)
        self.ids[[order[p] for p in model["vocab"] if p in order]] = [i for p, i in model["vocab"].items() if p in order]
        self.fast = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        plain = {bytes([b]): b for b in range(256)}
        self.probes = [tiktoken.Encoding(p, pat_str=p, mergeable_ranks=plain, special_tokens={}) for p in (r"\p{L}", r"\p{N}", r"\s")]
        self.splitter = WordSplitter(self.library)
        self.same: set[str] = set(filter(self._same, map(chr, range(128))))
        self.other: set[str] = set()
        by_length = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None

    def _same(self, char: str) -> bool:
        """Whether both libraries take the character for a letter, a number, white space or none of these."""
        known = self.splitter.classes[ord(char)]
        kind = self.splitter._class(ord(char)) if known == 255 else known
        letter, number, space = (len(p.encode_ordinary(char)) > 0 for p in self.probes)
        if kind in (OTHER, QUOTE):
            return not (letter or number or space)
        return number if kind == NUMBER else letter if kind <= LETTER and kind > QUOTE else space

    def _ids(self, text: str) -> np.ndarray:
        if not text.isascii():
            for char in set(text) - self.same - self.other:
                (self.same if self._same(char) else self.other).add(char)
        if text.isascii() or not self.other or self.other.isdisjoint(text):
            try:
                return self.ids[self.fast.encode_to_numpy(text)]
            except ValueError:  # a run of white space too long for its regular expressions
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        if self.cut is None or not self.cut.search(text):
            return self._ids(text)
        parts = [np.array([self.added[x]], np.uint32) if x in self.added else self._ids(x) for x in self.cut.split(text) if x]
        return np.concatenate(parts)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document's ids and the end id, cut every ``size`` ids.

    ``ids`` are little-endian unsigned 32-bit numbers, ``ids_crc32`` their checksum.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, owner, rows, parts = encoder(tokenizer).encode, [], [], []
        for at, text in enumerate(batch.column(1).to_pylist()):
            ids = np.append(encode(text), np.uint32(end)).astype("<u4")
            for start in range(0, len(ids), size):
                part = ids[start : start + size].tobytes()
                owner.append(at)
                rows.append((start, len(part) // 4, zlib.crc32(part), len(ids)))
                if with_ids:
                    parts.append(part)
        columns = [batch.column(0).take(pa.array(owner)), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    slim = docs.select("doc_id", text_or_empty("text").alias("text"))
    return per_batch(slim, run, f"doc_id {doc_type}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


@dataclass
class Plan:
    """Slots, one row each: ranks ``low`` to ``low + count`` of ``length`` go to that many sequences from ``sequence`` on, at ``offset``.

    ``patterns`` are the packs at the end: lengths and number of sequences.
    """

    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)
    sequences: int = 0


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Packs ``histogram`` (pieces by length, none above ``size``).

    Pieces that fit nowhere open packs; further ones of their length fit there while there is room.
    Its work and its result are bounded by ``size`` alone: a length opens two patterns and splits one
    at most, so there are at most 3 x size patterns of at most ``size`` pieces.
    """
    plan = Plan()
    by_room: list[list[tuple[int, int, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
    for length in sorted(histogram, reverse=True):
        low, left, room = 0, histogram[length], size
        while left:
            while room >= length and not by_room[room]:
                room -= 1
            if room < length:
                # fits nowhere: packs of as many as fit, and one of what is then left
                number = min(size // length, left)
                first, count = plan.sequences, left // number
                for i in range(number):
                    plan.slots.append((length, low + i * count, count, first, i * length))
                by_room[size - number * length].append((first, count, (length,) * number))
                plan.sequences += count
                low, left, room = low + number * count, left - number * count, size
                continue
            first, count, pattern = by_room[room].pop()
            here = min(count, left)
            if count > here:
                by_room[room].append((first + here, count - here, pattern))
            plan.slots.append((length, low, here, first, size - room))
            by_room[room - length].append((first, here, (*pattern, length)))
            low, left = low + here, left - here
    plan.patterns = [(pattern, count) for packs in by_room for _, count, pattern in packs]
    return plan


def ranked(staged: DataFrame) -> DataFrame:
    """``staged`` with ``rank``: numbers the rows of each length from 0. ``staged`` must come straight from files.

    Rows are numbered by chunks of a file, so a length that most rows have is not one task's.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.floor(F.col("_metadata.row_index") / CHUNK).alias("chunk"))
    placed = staged.select("*", at.alias("_chunk"), F.col("_metadata.row_index").alias("_row"))
    counts = placed.groupBy("length", "_chunk").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_chunk")) - F.col("_n")
    starts = stage(counts.select("length", "_chunk", before.alias("_before")), "rank-starts")
    within = F.row_number().over(Window.partitionBy("length", "_chunk").orderBy("_row")) - 1
    # rows are partitioned as the window left them; the starts grow with the files, so they are not broadcast
    numbered = placed.withColumn("_within", within).join(starts.hint("merge"), ["length", "_chunk"])
    return numbered.select(*staged.columns, (F.col("_before") + F.col("_within")).alias("rank"))


def pack_pieces(staged: DataFrame, size: int = SIZE) -> DataFrame:
    """``staged`` pieces, straight from files, with ``sequence_id`` and ``offset``."""
    histogram = {r.length: r.n for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    slots = np.array(sorted(shortest_pack_first(histogram, size).slots), np.int64).reshape(-1, 5)
    first_of = np.searchsorted(slots[:, 0], np.arange(size + 2))
    arrow_settings(staged.sparkSession)
    names = [*staged.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                own, lows = length == n, slots[first_of[n] : first_of[n + 1], 1]
                at[own] = first_of[n] + np.searchsorted(lows, rank[own], side="right") - 1
            slot = slots[at]
            columns = [*batch.columns[:-1], pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in staged.schema)
    return ranked(staged).mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset) of every piece of ``docs`` (doc_id, text, ...).

    A document is its ids and the end id; each id lies in one piece, ``start`` ids of the document
    before it. Sequences are numbered from 0 and are gapless from offset 0. Null and empty texts are
    the end id alone. Very long texts are many full sequences and one rest. Repeated rows and null
    doc_ids are packed as they come; extra columns are ignored; an empty table gives an empty
    result. ``tokenizer`` is the path of the tokenizer's file on every executor.
    """
    return pack_pieces(stage(pieces(docs, tokenizer, size, end, with_ids), "pieces"), size)


def sequences(packed: DataFrame, size: int = SIZE, end: int = END) -> DataFrame:
    """(sequence_id, n_tokens, ids) of ``pack(..., with_ids=True)``: filled up to ``size`` with the end id unless ``n_tokens`` is a power of two."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    ids = F.aggregate("held", F.lit(b""), lambda all_, piece: F.concat(all_, piece["ids"]))
    filled = F.when(F.bit_count("n_tokens") == 1, F.col("ids")).otherwise(F.rpad("ids", size * 4, F.lit(end.to_bytes(4, "little"))))
    return held.select("sequence_id", "n_tokens", ids.alias("ids")).withColumn("ids", filled)
