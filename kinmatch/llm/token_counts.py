"""Token counts from a byte-level BPE tokenizer compiled to finite-state transducers.

Two deterministic transducers replace the tokenizer. The first reads character classes and annotates
its transitions with the word boundaries they emit. A text is cut into chunks; each chunk's map from
entry state to exit state is computed without knowing where it starts, the maps compose through a
parallel prefix scan, and then every chunk knows its entry state. The second reads the bytes of a
word; each transition is annotated with the change of the number of tokens of the prefix read so
far. Its states are made when first reached: what matters of a prefix is which of its suffixes may
still grow into a token, each with the last token before it and its count, relative to the present.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinmatch.llm.common import per_batch, text_or_empty

#: Characters of a chunk, of the part of it that is read from all states at first, and of one round of texts.
CHUNK = 512
PROBE = 16
ROUND = 1 << 21
#: Entries of a task's table of words and of each memo of the word transducer; beyond that it starts anew.
TABLE = 400_000
WORD_CHARS = 48

# classes of characters: white space (blank, other), apostrophe, letters that may end a contraction
BLANK, SPACE, QUOTE, STMD, RV, LETTER_L, LETTER_E, LETTER, NUMBER, OTHER, PAD = range(11)
# states: the open token is none or complete, letters, numbers, others, white space (one or more
# characters, the last one a blank or not), an apostrophe, or an apostrophe and r or v, or l
CLEAR, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE, AFTER_QUOTE, QUOTE_RV, QUOTE_L = range(11)
HERE, BEFORE = 1, 2  # a token starts at this character, at the one before

_LETTERS = (STMD, RV, LETTER_L, LETTER_E, LETTER)


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state and class."""
    fresh = {BLANK: ONE_BLANK, SPACE: ONE_SPACE, QUOTE: AFTER_QUOTE, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS} | dict.fromkeys(_LETTERS, IN_LETTERS)
    run = {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS} | dict.fromkeys(_LETTERS, IN_LETTERS)
    to, out = np.zeros((11, 11), np.uint8), np.zeros((11, 11), np.uint8)
    for state in range(11):
        for kind in range(10):
            space, go = kind in (BLANK, SPACE), (fresh[kind], HERE)
            if state == IN_LETTERS and kind in _LETTERS or state == IN_NUMBERS and kind == NUMBER:
                go = (state, 0)
            elif state in (IN_OTHERS, AFTER_QUOTE) and kind in (OTHER, QUOTE):
                go = (IN_OTHERS, 0)
            elif state in (ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE):
                more = state in (MORE_BLANK, MORE_SPACE)
                if space:
                    go = (MORE_BLANK if kind == BLANK else MORE_SPACE, 0)
                elif state in (ONE_BLANK, MORE_BLANK):  # the last blank goes with what follows
                    go = (run[kind], BEFORE * more)
                else:
                    go = (fresh[kind], HERE + BEFORE * more)
            elif state == AFTER_QUOTE and kind in (STMD, RV, LETTER_L):
                go = ({STMD: CLEAR, RV: QUOTE_RV, LETTER_L: QUOTE_L}[kind], 0)
            elif state == QUOTE_RV and kind == LETTER_E or state == QUOTE_L and kind == LETTER_L:
                go = (CLEAR, 0)
            elif state in (QUOTE_RV, QUOTE_L):  # no contraction: the letter starts a token of its own
                go = (IN_LETTERS, BEFORE) if kind in _LETTERS else (fresh[kind], HERE + BEFORE)
            to[state, kind], out[state, kind] = go
        to[state, PAD] = state
    return to.ravel(), out.ravel()


class WordSplitter:
    def __init__(self, library: Tokenizer) -> None:
        self.library = library.pre_tokenizer
        self.to, self.out = _transitions()
        self.classes = np.full(0x110000, 255, np.uint8)
        known = {" ": BLANK, "'": QUOTE, "l": LETTER_L, "e": LETTER_E} | dict.fromkeys("stmd", STMD) | dict.fromkeys("rv", RV)
        for char, kind in known.items():
            self.classes[ord(char)] = kind

    def _class(self, point: int) -> int:
        """Of a character not met before, read off how the library splits it from a letter and a number."""
        char = chr(point)
        widths = [end - start for _, (start, end) in self.library.pre_tokenize_str(f"a{char}1")]
        if widths in ([2, 1], [1, 2]):
            return LETTER if widths == [2, 1] else NUMBER
        return OTHER if len(self.library.pre_tokenize_str(f"{char}!")) == 1 else SPACE

    def classify(self, points: np.ndarray) -> np.ndarray:
        kinds = self.classes[points]
        if (unknown := kinds == 255).any():
            for point in np.unique(points[unknown]).tolist():
                self.classes[point] = self._class(point)
            kinds = self.classes[points]
        return kinds

    def boundaries(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text (none empty) the positions where its words start, and its length."""
        sizes = np.array([len(x) for x in texts])
        kinds = self.classify(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
        chunks = -(-sizes // CHUNK)
        ends, chunk_ends = np.cumsum(sizes), np.cumsum(chunks)
        first = chunk_ends - chunks
        grid = np.full(int(chunk_ends[-1]) * CHUNK, PAD, np.uint8)
        shift = np.repeat(first * CHUNK - (ends - sizes), sizes)
        place = np.arange(len(kinds)) + shift
        grid[place] = kinds
        grid = np.ascontiguousarray(grid.reshape(-1, CHUNK).T)
        out = np.zeros(grid.shape, np.uint8)

        # maps of the chunks: from every entry state until all agree, mostly after a few characters
        maps = np.tile(np.arange(11, dtype=np.uint8)[:, None], (1, grid.shape[1]))
        for j in range(PROBE):
            maps = self.to[maps.astype(np.int32) * 11 + grid[j]]
        agree = (maps == maps[0]).all(axis=0)
        slow, state = np.flatnonzero(~agree), maps[0]
        rest = maps[:, slow]
        for j in range(PROBE, CHUNK):
            at = state.astype(np.int32) * 11 + grid[j]
            state, out[j] = self.to[at], self.out[at]
            if len(slow):
                rest = self.to[rest.astype(np.int32) * 11 + grid[j, slow]]
        maps = np.tile(state, (11, 1))
        maps[:, slow] = rest

        entry = prefix_scan(maps, first)
        # what depends on the entry: the first characters, and the whole of chunks whose states did not agree
        state = entry
        for j in range(PROBE):
            at = state.astype(np.int32) * 11 + grid[j]
            state, out[j] = self.to[at], self.out[at]
        for j in range(PROBE, CHUNK) if len(slow) else ():
            at = state[slow].astype(np.int32) * 11 + grid[j, slow]
            state[slow], out[j, slow] = self.to[at], self.out[at]

        flags = out.T.reshape(-1)[place]
        starts = (flags & HERE) > 0
        starts[:-1] |= (flags[1:] & BEFORE) > 0
        last = maps[entry[chunk_ends - 1], chunk_ends - 1]
        starts[ends[np.isin(last, (QUOTE_RV, QUOTE_L))] - 1] = True
        found = np.flatnonzero(starts)
        cuts = np.searchsorted(found, np.r_[0, ends])
        return [np.r_[found[a:b] - (e - n), n] for (a, b), e, n in zip(pairwise(cuts.tolist()), ends.tolist(), sizes.tolist(), strict=True)]


def prefix_scan(maps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Entry state of every chunk. ``maps``: exit by entry state and chunk; ``first``: chunks that start a text."""
    composed = maps.copy()
    composed[:, first] = maps[CLEAR, first]  # a text starts clear, whatever went before
    step, size = 1, maps.shape[1]
    columns = np.arange(size)
    while step < size:
        later = composed.copy()
        later[:, step:] = composed[composed[:, :-step], columns[step:]]
        composed, step = later, step * 2
    entry = np.full(size, CLEAR, np.uint8)
    entry[1:] = composed[CLEAR, :-1]
    entry[first] = CLEAR
    return entry


class WordCounter:
    """The transducer over the bytes of a word."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        raw = lambda piece: bytes(byte_of[c] for c in piece)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(raw(a), raw(b)): rank for rank, (a, b) in reversed(list(enumerate(merges)))}
        #: each beginning of a token, and whether it is a token itself
        self.beginnings: dict[bytes, bool] = {b"": False}
        for piece in model["vocab"]:
            token = raw(piece)
            for i in range(1, len(token)):
                self.beginnings.setdefault(token[:i], False)
            self.beginnings[token] = True
        self._clear()

    def _clear(self) -> None:
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[tuple, int] = {}
        self.items: list[tuple] = []
        self.next: list[dict[int, tuple[int, int]]] = []
        self.start = self._state(((b"", b"", 0),))

    def _state(self, items: tuple) -> int:
        if (state := self.states.get(items)) is None:
            state = self.states[items] = len(self.items)
            self.items.append(items)
            self.next.append({})
        return state

    def merged(self, word: bytes) -> list[bytes]:
        """The tokens of a short word by its merges, lowest rank first."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(pairwise(parts)))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, left: bytes, token: bytes) -> bool:
        """Whether ``token`` may stand after ``left``: the two alone must come out as just these two."""
        key = (left, token)
        if (ok := self.follows.get(key)) is None:
            ok = self.follows[key] = self.merged(left + token) == ([left, token] if left else [token])
        return ok

    def _step(self, state: int, byte: bytes) -> tuple[int, int]:
        """Next state and change of the number of tokens. An item: suffix that may grow, token before it, count relative to now."""
        grown = [(suffix + byte, left, count) for suffix, left, count in self.items[state] if suffix + byte in self.beginnings]
        token, change = next((s, count + 1) for s, left, count in grown if self.beginnings[s] and self._follows(left, s))
        items = (*((s, left, count - change) for s, left, count in grown), (b"", token, 0))
        return self._state(items), change

    def count(self, word: bytes) -> int:
        if len(self.items) > TABLE or len(self.follows) > TABLE:
            self._clear()
        state, total = self.start, 0
        for i, b in enumerate(word):
            if (go := self.next[state].get(b)) is None:
                go = self.next[state][b] = self._step(state, word[i : i + 1])
            state, change = go
            total += change
        return total


class TokenCounter:
    def __init__(self, path: str) -> None:
        library = Tokenizer.from_file(path)
        pre = json.loads(library.to_str())
        kind = pre["pre_tokenizer"] or {}
        if pre["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE tokenizer")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in pre["added_tokens"]):
            raise ValueError("added tokens with conditions")
        self.special = sorted((t["content"] for t in pre["added_tokens"]), key=len, reverse=True)
        self.splitter, self.counter = WordSplitter(library), WordCounter(path)
        self.table: dict[str, int] = {}

    def _miss(self, word: str) -> int:
        count = self.counter.count(word.encode("utf-8", "surrogatepass"))
        if len(word) <= WORD_CHARS:
            if len(self.table) >= TABLE:
                self.table.clear()
            self.table[word] = count
        return count

    def _segments(self, text: str) -> tuple[list[str], int]:
        """The text between strings of added tokens, and how many of these there are: each is one token."""
        parts, number = [text], 0
        for special in self.special:
            if special in text:
                parts = [x for part in parts for x in part.split(special)]
        number = len(parts) - 1
        return [x for x in parts if x], number

    def counts(self, texts: list[str]) -> list[int]:
        totals, owner, segments, size = [0] * len(texts), [], [], 0
        for i, text in enumerate(texts):
            parts, totals[i] = self._segments(text)
            owner += [i] * len(parts)
            segments += parts
            size += len(text)
            if size > ROUND or i == len(texts) - 1:
                self._add(totals, owner, segments)
                owner, segments, size = [], [], 0
        return totals

    def _add(self, totals: list[int], owner: list[int], segments: list[str]) -> None:
        if not segments:
            return
        get = self.table.get
        for i, text, cuts in zip(owner, segments, self.splitter.boundaries(segments), strict=True):
            for a, b in pairwise(cuts.tolist()):
                word = text[a:b]
                count = get(word)
                totals[i] += self._miss(word) if count is None else count


@lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text, ...): whole texts, exactly as the library counts.

    Null text counts as empty: no bytes, no tokens. Strings of added tokens inside a text are one
    token each. Repeated rows and null doc_ids come back as they are; extra columns are ignored.
    ``tokenizer`` is the path of the tokenizer's file on every executor.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = pa.array(token_counter(tokenizer).counts(batch.column(1).to_pylist()), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["doc_id", "n_bytes", "n_tokens"])

    text = text_or_empty("text")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return per_batch(slim, run, "doc_id long, n_bytes long, n_tokens long")
