"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary text.

The two models are first-order transition tables over the characters that secrets are made of. They
are learned from labelled strings: what the fixed patterns find in the corpus is random, everything
else that is written with the same characters is ordinary. A run of such characters, apart from
what the patterns found in it, is a finding when the log-likelihood ratio of the two models speaks
for random; if the whole run does not, its stretches with the highest running ratio may.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import per_batch, text_or_empty

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Order of kinds at equal starts.
KINDS = ("assign", "access", "hex", "markov")

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: A run is one finding if its best stretch is so much of it.
MOST = 0.6
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

_SIZE = len(ALPHABET)
_CODES = np.full(128, _SIZE, np.int64)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(_SIZE)


@dataclass(frozen=True)
class Params:
    """Characters are random if their ratio is ``total`` nats or more, and ``mean`` or more a transition. Nothing else bounds their number."""

    total: float = 15.0
    mean: float = 0.6
    smoothing: float = 1.0


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(begin, kind, end, begin of the secret itself) of what the fixed patterns find, by begin and kind."""
    spans = [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    for run in RUN.finditer(text):  # findings of the other kinds lie inside of such runs
        for kind, pattern, least in ((1, ACCESS, 20), (2, HEX, 24)):
            spans += [(m.start(), kind, m.end(), m.start()) for m in pattern.finditer(text, *run.span()) if m.end() - m.start() >= least]
    return sorted(spans)


def _codes(text: str) -> np.ndarray:
    return _CODES[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 127)]


def transitions(text: str) -> np.ndarray:
    """Codes of neighbouring characters that both belong to the alphabet."""
    codes = _codes(text)
    first, second = codes[:-1], codes[1:]
    return (first * _SIZE + second)[(first < _SIZE) & (second < _SIZE)]


def transition_counts(docs: DataFrame) -> DataFrame:
    """(code, n_random, n_ordinary) over all documents: at most one row for each pair of characters."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        random, every = np.zeros(_SIZE * _SIZE, np.int64), np.zeros(_SIZE * _SIZE, np.int64)
        for text in batch.column(0).to_pylist():
            every += np.bincount(transitions(text), minlength=len(every))
            for _, _, end, begin in base_spans(text):
                random += np.bincount(transitions(text[begin:end]), minlength=len(random))
        codes = np.flatnonzero(every)
        ordinary = np.maximum(every - random, 0)
        return pa.RecordBatch.from_arrays([pa.array(x[codes] if x is not None else codes) for x in (None, random, ordinary)], ["code", "n_random", "n_ordinary"])

    found = per_batch(docs.select(text_or_empty("text").alias("text")), run, "code long, n_random long, n_ordinary long")
    return found.groupBy("code").agg(F.sum("n_random").alias("n_random"), F.sum("n_ordinary").alias("n_ordinary"))


def fit(counts: DataFrame, params: Params = Params()) -> np.ndarray:
    """Log-likelihood ratio, random over ordinary, of each transition. Without samples of one kind that model is uniform."""
    tables = np.full((2, _SIZE * _SIZE), params.smoothing)
    for row in counts.collect():  # one for each pair of characters at most
        tables[0, row.code] += row.n_random
        tables[1, row.code] += row.n_ordinary
    tables = tables.reshape(2, _SIZE, _SIZE)
    logs = np.log(tables) - np.log(tables.sum(axis=2, keepdims=True))
    return (logs[0] - logs[1]).ravel()


def random_stretches(steps: np.ndarray, params: Params) -> list[tuple[int, int]]:
    """(first, last) character of what is random among the characters that ``steps``, the ratios of their transitions, lie between.

    It is the stretch where the ratio grows most, or all of them where that is most of them and they
    are random as a whole; then what is left and right of it is looked at.
    """
    found, open_ = [], [(0, len(steps))]
    while open_:
        begin, end = open_.pop()
        part = steps[begin:end]
        if not len(part):
            continue
        sums = np.r_[0.0, np.cumsum(part)]
        grown = sums - np.minimum.accumulate(sums)
        last = int(np.argmax(grown))
        if grown[last] < params.total:
            continue
        first = int(np.argmin(sums[: last + 1]))
        if last - first >= MOST * len(part) and sums[-1] >= max(params.total, params.mean * len(part)):
            found.append((begin, end))
            continue
        if grown[last] >= params.mean * (last - first):
            found.append((begin + first, begin + last))
        open_ += [(begin, begin + max(first - 1, 0)), (begin + last + 1, end)]
    return found


def _apart(begin: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of begin to end that no span covers; spans come in order."""
    parts = []
    for b, _, e in spans:
        if e > begin and b < end:
            parts.append((begin, b))
            begin = max(begin, e)
    return [(b, e) for b, e in [*parts, (begin, end)] if e - b > 1]


def all_spans(text: str, ratio: np.ndarray, params: Params = Params()) -> list[tuple[int, int, int]]:
    """(begin, kind, end): the base findings and, apart from them, what looks random."""
    base = [s[:3] for s in base_spans(text)]
    codes = _codes(text)
    inside = codes < _SIZE
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return base
    joined = inside[:-1] & inside[1:]
    steps = np.where(joined, ratio[np.where(joined, codes[:-1] * _SIZE + codes[1:], 0)], 0.0)
    # no part of a run reaches more than the sum of its steps for random
    most = np.r_[0.0, np.cumsum(np.maximum(steps, 0.0))]
    found = []
    for i in np.flatnonzero(most[ends - 1] - most[begins] >= params.total - 1e-6).tolist():
        for begin, end in _apart(int(begins[i]), int(ends[i]), base):
            found += [(begin + a, 3, begin + b + 1) for a, b in random_stretches(steps[begin : end - 1], params)]
    return sorted(base + found)


def scan(docs: DataFrame, ratio: np.ndarray, params: Params = Params()) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``: kind, begin, end in code points, by begin, then by kind as in ``KINDS``.

    Null text counts as empty and has no spans; repeated rows and null doc_ids come back as they are;
    extra columns are ignored.
    """
    kind = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = ([(KINDS[k], b, e) for b, k, e in all_spans(text, ratio, params)] for text in batch.column(1).to_pylist())
        spans = pa.array([[dict(zip(("kind", "begin", "end"), s, strict=True)) for s in row] for row in rows], pa.list_(kind))
        return pa.RecordBatch.from_arrays([batch.column(0), spans], ["doc_id", "spans"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return per_batch(slim, run, "doc_id long, spans array<struct<kind:string,begin:bigint,end:bigint>>")
