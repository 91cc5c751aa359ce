"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into blocks of 23 bits, and the words of the perfect binary Golay code of that
length are the anchors of a block: every block value lies within 3 bits (the covering radius) of
exactly one of them. A fingerprint lives at its own anchor and is also sent to every anchor within
the radius plus the threshold. Two fingerprints that differ in at most ``threshold`` bits then meet
at the anchor where either of them lives, so only the rows of one anchor are compared. The rows of a
hot anchor are cut into blocks, and each block of rows that live there meets each block of all its
rows in a cell of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import arrow_settings, components, per_batch, stage, text_or_empty
from kinmatch.llm.exact_dedup import located
from kinmatch.session import settled

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
RADIUS = 3
BITS = 23
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b101011100011
#: Rows of one anchor that one task compares. A larger anchor is cut into blocks of so many rows.
CELL_ROWS = 4096

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingles(text: str, words: int) -> list[str]:
    """Shingles of ``words`` words of the text with A-Z lowered, repeats included; a shorter text is one."""
    parts = WORD.findall(text.translate(LOWER))
    if words == 1 or not parts:
        return parts
    if len(parts) <= words:
        return [" ".join(parts)]
    return list(map(" ".join, zip(*(parts[i:] for i in range(words)))))


def fingerprint(features: list[str], seed: int = 42) -> int:
    """Bit i is 1 if set in more than half of the features' XXH64; no feature: 0."""
    if not features:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, seed) for x in features], dtype=">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > len(features)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row: ``fp`` holds the 64 bits as a long. Null text counts as empty; doc_id has any type that orders."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = (fingerprint(shingles(x, words)) for x in batch.column(1).to_pylist())
        fp = np.fromiter(out, dtype=np.uint64, count=batch.num_rows).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    slim = docs.select("doc_id", text_or_empty("text").alias("text"))
    return per_batch(slim, run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp long")


def _syndrome(values: np.ndarray) -> np.ndarray:
    rest = values.copy()
    for bit in range(BITS - 1, 10, -1):
        rest ^= np.where((rest >> bit) & 1, GOLAY << (bit - 11), 0)
    return rest


@lru_cache(maxsize=4)
def offsets(threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the masks that lead from a value to each anchor within radius + threshold, and by how much each exceeds the radius."""
    found: dict[int, list[tuple[int, int]]] = {}
    for weight in range(RADIUS + threshold + 1):
        masks = np.array([sum(1 << i for i in c) for c in combinations(range(BITS), weight)], dtype=np.int64)
        for mask, syndrome in zip(masks.tolist(), _syndrome(masks).tolist(), strict=True):
            found.setdefault(syndrome, []).append((max(0, weight - RADIUS), mask))
    width = max(map(len, found.values()))
    masks, excess = np.zeros((1 << 11, width), np.int64), np.full((1 << 11, width), 99, np.int8)
    for syndrome, entries in found.items():
        excess[syndrome, : len(entries)], masks[syndrome, : len(entries)] = zip(*entries, strict=True)
    return masks, excess


def anchors(values: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of each fingerprint and each anchor that it is sent to."""
    masks, excess = offsets(threshold)
    row = np.arange(len(values))
    anchor, over = np.zeros(len(values), np.int64), np.zeros(len(values), np.int8)
    for low in (0, BITS):
        block = ((values[row] >> np.uint64(low)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
        syndrome = _syndrome(block)
        total = over[:, None] + excess[syndrome]
        at, which = np.nonzero(total <= threshold)
        row, over = row[at], total[at, which]
        anchor = (anchor[at] << BITS) | (block[at] ^ masks[syndrome[at], which])
    return row, anchor, over == 0


def _sent(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.column(0).slice(start, 4096).to_numpy()
                row, anchor, home = anchors(part.view(np.uint64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row]), pa.array(home)], ["anchor", "fp", "home"])

    return run


def _cell_links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): links among the rows of each anchor as a spanning forest; rows come sorted by anchor."""
    values = fp.view(np.uint64)
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    small = sizes <= 64
    alive = np.flatnonzero(np.repeat(small, sizes))
    ends = np.repeat(starts + sizes, sizes)
    for step in range(1, int(sizes[small].max(initial=1))):
        alive = alive[alive + step < ends[alive]]
        near = np.bitwise_count(values[alive] ^ values[alive + step]) <= threshold
        hit = alive[near & (home[alive] | home[alive + step])]
        left.append(fp[hit])
        right.append(fp[hit + step])
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        # one comparison of each home row with the whole cell; labels keep a forest instead of all pairs
        cell, label = values[start : start + size], np.arange(size)
        for i in np.flatnonzero(home[start : start + size]).tolist():
            near = np.flatnonzero(np.bitwise_count(cell ^ cell[i]) <= threshold)
            groups, first = np.unique(label[near], return_index=True)
            if len(groups) > 1:
                others = near[first[groups != label[i]]]
                left.append(np.full(len(others), cell[i]).view(np.int64))
                right.append(cell[others].view(np.int64))
                label[np.isin(label, groups)] = groups[0]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x or [none]) for x in (left, right))


def _links(threshold: int, cell_rows: int):
    """Rows sorted by anchor in; links (a, b) out, and as they came the rows of each anchor beyond ``cell_rows``."""
    names = ["a", "b", "anchor", "fp", "home"]

    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int64(), pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *none], names)

    def put_off(rows: list[np.ndarray]) -> pa.RecordBatch:
        none = [pa.nulls(len(rows[0]), pa.int64())] * 2
        return pa.RecordBatch.from_arrays([*none, *map(pa.array, rows)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, full = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)], None
        for batch in batches:
            part = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns, strict=True)]
            if not len(part[0]):
                continue
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last anchor may go on
            rest, part = [x[cut:] for x in part], [x[:cut] for x in part]
            for rows in (part, rest):
                anchor = rows[0]
                if full is not None and len(anchor) and anchor[0] == full:
                    go = int(np.searchsorted(anchor, full, side="right"))
                    yield put_off([x[:go] for x in rows])
                    rows[:] = [x[go:] for x in rows]
            sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, part[0][1:] != part[0][:-1]]), len(part[0])]) if len(part[0]) else []
            large = np.repeat(np.asarray(sizes) > cell_rows, sizes) if len(part[0]) else np.zeros(0, bool)
            if large.any():
                yield put_off([x[large] for x in part])
                part = [x[~large] for x in part]
            if len(rest[0]) > cell_rows:
                full = int(rest[0][0])
                yield put_off(rest)
                rest = [x[:0] for x in rest]
            if len(part[0]) > 1:
                yield pairs(*_cell_links(*part, threshold))
        if len(rest[0]) > 1:
            yield pairs(*_cell_links(*rest, threshold))

    return run


def _hot_links(rows: DataFrame, threshold: int, cell_rows: int) -> DataFrame:
    """(a, b): links of the anchors that are too large for one task.

    The rows that live at an anchor and all its rows are cut into blocks; each two of them meet in a
    cell (anchor, block of home rows, block of rows). Blocks go by hash, twice as many as needed on
    average.
    """
    blocks = lambda n: F.ceil(F.col(n) * F.lit(2.0 / cell_rows)).cast("long")
    sizes = rows.groupBy("anchor").agg(F.count("*").alias("all"), F.count_if("home").alias("homes"))
    sizes = stage(sizes.where("homes > 0").select("anchor", blocks("all").alias("all"), blocks("homes").alias("homes")), "hot-anchors")
    rows = rows.join(sizes, "anchor")
    spread = lambda n, seed: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    homes = rows.where("home").select("anchor", spread("homes", 1).alias("i"), "fp", every("all").alias("j"), F.lit(True).alias("home"))
    others = rows.select("anchor", spread("all", 2).alias("j"), "fp", every("homes").alias("i"), F.lit(False).alias("home"))

    def cell(table: pa.Table) -> pa.Table:
        fp, home = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("fp", "home"))
        a, b = _cell_links(np.zeros(len(fp), np.int64), fp, home, threshold)
        return pa.table({"a": a, "b": b})

    return homes.unionByName(others).groupBy("anchor", "i", "j").applyInArrow(cell, "a long, b long").where("a <> b")


def links(values: DataFrame, threshold: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): a forest of links whose components are those of all pairs of ``fp`` within ``threshold`` bits.

    ``values`` should hold each ``fp`` once; repeats only cost time. No task compares more than about
    ``cell_rows`` rows that live at an anchor with as many of its rows.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("threshold: 0 to 3")
    arrow_settings(values.sparkSession)
    sent = values.select("fp").mapInArrow(_sent(threshold), "anchor long, fp long, home boolean")
    ordered = sent.repartition("anchor").sortWithinPartitions("anchor")
    met = stage(ordered.mapInArrow(_links(threshold, cell_rows), "a long, b long, anchor long, fp long, home boolean"), "anchor-links")
    found, hot = met.where("b IS NOT NULL").select("a", "b"), met.where("b IS NULL").select("anchor", "fp", "home")
    if hot.isEmpty():
        return found
    return found.unionByName(stage(_hot_links(hot, threshold, cell_rows), "hot-anchor-links"))


def near_duplicate_groups(docs: DataFrame, words: int = 3, threshold: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row.

    Documents link when their fingerprints over shingles of ``words`` words differ in at most
    ``threshold`` bits; ``component_id`` is the smallest doc_id that can be reached. Equal
    fingerprints are one node, so copies never meet pair by pair. Null and empty texts have
    fingerprint 0 and link like any other; repeated rows come back repeated; a null doc_id is kept
    and is never a component_id unless its component holds no other (then null). Extra columns are
    ignored, an empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, words), "fingerprints")
    return grouped(prints, threshold)


def grouped(prints: DataFrame, threshold: int) -> DataFrame:
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    roots = components(links(nodes, threshold), "fingerprint-links")
    by_root = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = by_root.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = stage(by_root.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame, words: int = 3, threshold: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of ``near_duplicate_groups``.

    The row with the smallest doc_id stays; null doc_ids come last, and of rows that repeat a doc_id
    the first by file and row number stays. All texts without words are one group.
    """
    columns, docs = docs.columns, located(docs)
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_at").alias("doc_id"), "text")

    def gone() -> DataFrame:
        return near_duplicate_groups(keyed, words, threshold).where("doc_id <> component_id").select(F.col("doc_id._at").alias("_at"))

    gone = settled(docs.sparkSession, "near-copies", gone)
    return docs.join(gone.hint("merge"), "_at", "left_anti").select(*columns)  # its size has no bound: no broadcast
