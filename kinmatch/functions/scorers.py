"""String similarity for pair columns: LCS length and best-window ratio as Arrow UDFs.

Both work on whole Arrow batches with numpy: one bit vector per pair, advanced one character
position at a time for all pairs together. Everything that is set or arithmetic work around them
(sorted tokens, leftovers, the ratios) stays in column expressions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BITS = 64
VECTOR_LIMIT = 256  # characters of the bit-vector side; longer pairs go one by one
PARTIAL_CELLS = 4_000_000  # characters of one side x the other; longer pairs go one by one
BATCH_CELLS = 1_000_000  # pairs x longest text handled at once
BATCH_ROWS = 2048  # pairs handled at once
WINDOW_ROWS = 65_536  # windows of these pairs handled at once


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with -1, and lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    width = int(sizes.max(initial=0))
    grid = np.full((len(texts), width), -1, np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    grid[np.arange(width) < sizes[:, None]] = flat
    return grid, sizes


def _numbered(grid: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of ``grid`` as numbers by position, those of ``other`` likewise, and the first number of every row.

    Each row has numbers of its own; its first one is 'nowhere in ``grid``', and padding.
    """
    known = np.zeros(max(grid.max(initial=-1), other.max(initial=-1)) + 2, np.int64)  # the last one is that of padding
    known[grid] = 1
    known[-1] = 0
    letters = np.flatnonzero(known)
    known[letters] = np.arange(1, len(letters) + 1)
    first = np.arange(len(grid)) * (len(letters) + 1)
    return known[grid.T] + first, known[other.T] + first, first


def _masks(number: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Where each letter of the texts ``number`` stands, as 64-bit words ``[word, number]`` of ``size`` numbers."""
    width = len(number)
    table = np.zeros((max(1, -(-width // WORD_BITS)), size), np.uint64)
    for at in range(width):
        table[at // WORD_BITS, number[at]] |= np.uint64(1) << np.uint64(at % WORD_BITS)
    table[:, first] = 0
    return table


def _table(grid: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_masks` of ``grid`` and what :func:`_numbered` gives."""
    number, others, first = _numbered(grid, other)
    size = len(grid) * int(first[1] if len(first) > 1 else number.max(initial=0) + 1)
    return _masks(number, first, size), number, others, first


def _advance(state: np.ndarray, table: np.ndarray, letter: np.ndarray) -> None:
    """One character for every row: ``state`` is ``[word, row]`` and changes in place, ``letter`` has a number of ``table`` a row."""
    if len(state) == 1:
        (bits,) = state
        met = table[0].take(letter)
        met &= bits
        rest = bits - met
        bits += met
        bits |= rest
        return
    carry = np.zeros(state.shape[1], np.uint64)
    for word in range(state.shape[0]):
        old = state[word]
        met = old & table[word].take(letter)
        total = old + met
        over = total < old
        with_carry = total + carry
        over |= with_carry < total
        state[word] = with_carry | (old - met)
        carry = over.astype(np.uint64)


def _fresh(table: np.ndarray, rows: int) -> np.ndarray:
    return np.full((len(table), rows), ~np.uint64(0))


def _zeros(state: np.ndarray) -> np.ndarray:
    return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def _lcs_big(a: str, b: str) -> int:
    """One long pair, with Python's unbounded integers as the bit vector."""
    where: dict[str, int] = {}
    for at, char in enumerate(a):
        where[char] = where.get(char, 0) | (1 << at)
    full = (1 << len(a)) - 1
    state = full
    for char in b:
        met = state & where.get(char, 0)
        state = ((state + met) | (state - met)) & full
    return len(a) - state.bit_count()


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence length of each pair, in code points."""
    n1, n2 = (np.fromiter(map(len, side), np.int64, len(side)) for side in (left, right))
    least, most = np.minimum(n1, n2), np.maximum(n1, n2)
    same = np.fromiter(map(eq, left, right), bool, len(left))
    out = np.where(same, n1, 0)
    for i in np.flatnonzero(~same & (least > VECTOR_LIMIT)).tolist():
        out[i] = _lcs_big(*sorted((left[i], right[i]), key=len))
    small = np.flatnonzero(~same & (least > 0) & (least <= VECTOR_LIMIT))
    # pairs of like size together, so that no short pair waits for a long one
    small = small[np.lexsort((most[small], (least[small] - 1) // WORD_BITS))]
    left_first = (n1 <= n2).tolist()
    for cut in _cuts(most[small].tolist(), BATCH_ROWS, BATCH_CELLS):
        rows = small[cut]
        short = [left[i] if left_first[i] else right[i] for i in rows.tolist()]
        long = [right[i] if left_first[i] else left[i] for i in rows.tolist()]
        table, _, number, _ = _table(_codes(short)[0], _codes(long)[0])
        state = _fresh(table, len(rows))
        for letter in number:
            _advance(state, table, letter)
        out[rows] = _zeros(state)
    return out


def _windows_best(short: list[str], long: list[str]) -> np.ndarray:
    """Best ratio of each ``short`` against every window of its ``long`` (len(short) <= len(long)).

    Prefixes and suffixes take one walk each, read from the front and from the back; their last steps are the first
    and the last whole window. A window one further shares at most one character more, so of the windows between two
    known ones none shares more than half of the sum of both and the distance: they are halved while that may win.
    """
    grid, m = _codes(short)
    other, n = _codes(long)
    table, number, others, first = _table(grid, other)
    each, width = np.arange(len(short)), grid.shape[1]
    best, ends = np.zeros(len(short)), []
    # from the back: positions of a text counted from its end; beyond its start is padding
    back, behind = np.arange(width)[:, None], n - np.arange(width)[:, None] - 1
    own = np.where(back < m, number[np.maximum(m - back - 1, 0), each], first)
    for masks, walked in (
        (table, others[:width]),
        (_masks(own, first, table.shape[1]), others[np.maximum(behind, 0), each]),
    ):
        state = _fresh(masks, len(short))
        for step, letter in enumerate(np.where(back < m, walked, first)):
            _advance(state, masks, letter)
            met = _zeros(state)
            # past its end a text gains nothing, and its ratio only falls
            np.maximum(best, 2.0 * met / (m + step + 1), out=best)
        ends.append(met)
    row, lo, hi, at_lo, at_hi = each, np.zeros_like(n), n - m, *ends
    flat = others.ravel()
    while len(row):
        open_ = (hi - lo > 1) & ((at_lo + at_hi + hi - lo) // 2 / m[row] > best[row])
        row, lo, hi, at_lo, at_hi = (x[open_] for x in (row, lo, hi, at_lo, at_hi))
        if not len(row):
            break
        mid = (lo + hi) // 2
        at_mid = _window_lcs(table, flat, first, len(short), m, row, mid)
        np.maximum.at(best, row, at_mid / m[row])
        row, lo, hi = np.tile(row, 2), np.concatenate([lo, mid]), np.concatenate([mid, hi])
        at_lo, at_hi = np.concatenate([at_lo, at_mid]), np.concatenate([at_mid, at_hi])
    return best


def _window_lcs(
    table: np.ndarray, flat: np.ndarray, first: np.ndarray, rows: int, m: np.ndarray, row: np.ndarray, begin: np.ndarray
) -> np.ndarray:
    """LCS length of ``row`` and the window of ``m`` letters from ``begin``; ``flat`` is ``[position, rows]``."""
    out = np.zeros(len(row), np.int64)
    for at in range(0, len(row), WINDOW_ROWS):
        part = slice(at, at + WINDOW_ROWS)
        r, size = row[part], m[row[part]]
        spot, state = begin[part] * rows + r, _fresh(table, len(r))
        for step in range(int(size.max(initial=0))):
            live = step < size
            _advance(state, table, np.where(live, flat.take(np.where(live, spot + step * rows, 0)), first[r]))
        out[part] = _zeros(state)
    return out


def _steps(short: str, text: str) -> Iterator[int]:
    """LCS length of ``short`` with every prefix of ``text``."""
    where: dict[str, int] = {}
    for at, char in enumerate(short):
        where[char] = where.get(char, 0) | (1 << at)
    full = state = (1 << len(short)) - 1
    for char in text:
        met = state & where.get(char, 0)
        state = ((state + met) | (state - met)) & full
        yield len(short) - state.bit_count()


def _partial_big(short: str, long: str) -> float:
    """One long pair. Prefixes and suffixes take one walk each, the windows between only where they can win.

    A window one further shares at most one character more, so between two known windows no other
    shares more than half of the sum of both lengths and the distance; the best such gap is halved first.
    """
    m, last = len(short), len(long) - len(short)
    ends = [list(_steps(short, long[:m])), list(_steps(short[::-1], long[::-1][:m]))]
    best = max(2.0 * met / (m + size) for walk in ends for size, met in enumerate(walk, 1))
    gaps = [(-((ends[0][-1] + ends[1][-1] + last) // 2), 0, last, ends[0][-1], ends[1][-1])]
    while gaps:
        bound, lo, hi, at_lo, at_hi = heapq.heappop(gaps)
        if hi - lo < 2 or -bound / m <= best:  # 2 x bound / 2m
            continue
        mid = (lo + hi) // 2
        *_, at_mid = _steps(short, long[mid : mid + m])
        best = max(best, at_mid / m)
        for x in ((lo, mid, at_lo, at_mid), (mid, hi, at_mid, at_hi)):
            heapq.heappush(gaps, (-((x[2] + x[3] + x[1] - x[0]) // 2), *x))
    return best


def _cuts(sizes: list[int], rows: int, cells: int) -> Iterator[slice]:
    """Slices of at most ``rows`` texts whose padded grid has at most ``cells`` cells (or one text)."""
    start, width = 0, 0
    for i, size in enumerate(sizes):
        width = max(width, size)
        if i > start and (i - start >= rows or (i - start + 1) * width > cells):
            yield slice(start, i)
            start, width = i, size
    if start < len(sizes):
        yield slice(start, len(sizes))


def partial_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Best ratio of the shorter text over all windows of the longer one, 0..1."""
    out = np.zeros(len(left))
    jobs: list[tuple[int, str, str]] = []
    for i, (a, b) in enumerate(zip(left, right)):
        if not a or not b:
            out[i] = float(a == b)
            continue
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if short in long:
            out[i] = 1.0
            continue
        pairs = [(short, long)] + ([(long, short)] if len(a) == len(b) else [])
        for x, y in pairs:
            if len(x) > VECTOR_LIMIT or len(x) * len(y) > PARTIAL_CELLS:
                out[i] = max(out[i], _partial_big(x, y))
            else:
                jobs.append((i, x, y))
    jobs.sort(key=lambda job: ((len(job[1]) - 1) // WORD_BITS, len(job[1]) // 8, len(job[2])))
    for cut in _cuts([len(long) for _, _, long in jobs], BATCH_ROWS, BATCH_CELLS):
        part = jobs[cut]
        np.maximum.at(out, [i for i, _, _ in part], _windows_best([x for _, x, _ in part], [y for _, _, y in part]))
    return out


def _distinct(left: pd.Series, right: pd.Series) -> tuple[list[str], list[str], np.ndarray]:
    """Fold repeated pairs of a batch."""
    pairs: dict[tuple[str, str], int] = {}
    codes = np.fromiter((pairs.setdefault(pair, len(pairs)) for pair in zip(left, right)), np.int64, len(left))
    return [a for a, _ in pairs], [b for _, b in pairs], codes


# plain Series functions, so that all scores of a pair share one exchange with Python


@F.pandas_udf(T.IntegerType())
def lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    a, b, codes = _distinct(left, right)
    return pd.Series(lcs_lengths(a, b)[codes].astype(np.int32))


@F.pandas_udf(T.DoubleType())
def partial_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    a, b, codes = _distinct(left, right)
    return pd.Series(partial_ratios(a, b)[codes])


def register(spark: SparkSession) -> None:
    """Make the two UDFs callable from SQL text."""
    spark.udf.register("lcs_length", lcs_length)
    spark.udf.register("partial_ratio", partial_ratio)


def ratio_of(left: Column, right: Column, lcs: Column) -> Column:
    """Indel ratio 0..1 from an LCS length; two empty texts are equal."""
    size = F.length(left) + F.length(right)
    return F.when(size == 0, 1.0).otherwise(2.0 * lcs / size)
