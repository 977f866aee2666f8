"""Token counts by a compiled finite-state transducer over characters.

The word pattern of the tokenizer becomes a deterministic transducer over
character classes. Text is cut into rows of equal length; every row is read
from all states at once, which gives its state map, and the maps are composed
by a parallel prefix scan, so each row learns the state it is entered in
without the rows before it being read in order. A second pass from the known
states marks where tokens of the pattern begin. The step that ends a word emits
the word's number of tokens, which is compiled once per distinct word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from zoneflow.llm.text import Memo, map_batches, word_pieces

ROW = 128
# States: between words, in letters, in other signs, after an apostrophe that opens a word, and after it r, v or l.
BETWEEN, LETTERS, SIGNS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
STATES = 7
# Classes of characters; letters that matter after an apostrophe have their own.
SPACE, NUMBER, SIGN, APOSTROPHE, ENDING, R, V, L, E, LETTER = range(10)
CLASSES = 10
BEGINS, BEGAN_BEFORE = 1, 2
LIMIT = 0x250
_U = np.uint64


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each character, next state and emission by state * CLASSES + class."""
    classes = np.zeros(LIMIT, np.uint8)
    for code in range(LIMIT):
        c = chr(code)
        if regex.match(r"\s", c):
            classes[code] = SPACE
        elif regex.match(r"\p{N}", c):
            classes[code] = NUMBER
        elif regex.match(r"\p{L}", c):
            classes[code] = {"r": R, "v": V, "l": L, "e": E}.get(c, ENDING if c in "stmd" else LETTER)
        else:
            classes[code] = APOSTROPHE if c == "'" else SIGN
    step, out = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    for kind in range(CLASSES):
        letter = kind >= ENDING
        fresh = BETWEEN if kind in (SPACE, NUMBER) else LETTERS if letter else QUOTE if kind == APOSTROPHE else SIGNS
        for state in range(STATES):
            step[state, kind], out[state, kind] = fresh, BEGINS if kind != SPACE else 0
        if letter:
            out[LETTERS, kind] = 0
        if kind in (SIGN, APOSTROPHE):
            for state in (SIGNS, QUOTE):
                step[state, kind], out[state, kind] = SIGNS, 0
        if kind == ENDING:
            step[QUOTE, kind], out[QUOTE, kind] = BETWEEN, 0
        for state, own, close in ((QUOTE_R, R, E), (QUOTE_V, V, E), (QUOTE_L, L, L)):
            if kind == own:
                # Whether this letter continues the apostrophe's word shows one step later.
                step[QUOTE, kind], out[QUOTE, kind] = state, 0
            if kind == close:
                step[state, kind], out[state, kind] = BETWEEN, 0
            else:
                step[state, kind] = step[LETTERS, kind]
                out[state, kind] = out[LETTERS, kind] | BEGAN_BEFORE
    return classes, step.ravel(), out.ravel()


def word_starts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each character, whether a pattern word begins there and whether it is white space; `codes` end in white space."""
    classes, step, out = _tables()
    rows = -(-len(codes) // ROW)
    kinds = np.zeros(rows * ROW, np.uint8)
    kinds[:len(codes)] = classes[codes]
    by_column = np.ascontiguousarray(kinds.reshape(rows, ROW).T)
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for column in by_column:
        maps = step[maps * np.uint8(CLASSES) + column[:, None]]
    # Prefix scan: after it, maps[i] carries the composition of rows 0 to i.
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], 1)
        reach *= 2
    state = np.concatenate([np.full(1, BETWEEN, np.uint8), maps[:-1, BETWEEN]])
    emitted = np.empty((ROW, rows), np.uint8)
    for j, column in enumerate(by_column):
        at = state * np.uint8(CLASSES) + column
        emitted[j], state = out[at], step[at]
    flat = emitted.T.ravel()
    begins = (flat & BEGINS).astype(bool)
    begins[:-1] |= (flat[1:] & BEGAN_BEFORE).astype(bool)
    return begins[:len(codes)], kinds[:len(codes)] == SPACE


class WordTokens:
    """Number of tokens by word, as the tokenizer's own merges give it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words = Memo(lambda word: len(word_pieces(self.model, word)), 1_000_000)

    def count(self, text: str) -> int:
        return len(self.whole.encode(text, add_special_tokens=False).ids)


@lru_cache(2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _plain(text: str) -> bool:
    """Whether the transducer's alphabet has every character and no special string can occur."""
    return (text.isascii() or max(text) < chr(LIMIT) and "İ" not in text) and "<|" not in text


def count_tokens(texts: list[str], model: WordTokens) -> np.ndarray:
    """Token counts of plain texts, all read in one run with white space between them."""
    joined = " ".join(texts).lower() + " "
    lengths = np.array([len(t) + 1 for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    begins, space = word_starts(codes)
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(len(texts), np.int64)
    gaps = np.flatnonzero(space)
    ends = np.minimum(np.append(starts[1:], len(codes)), gaps[np.searchsorted(gaps, starts)])
    # Words of a batch are told apart by a polynomial over their characters and their length.
    weights = np.multiply.accumulate(np.full(len(codes), 0x9E3779B97F4A7C15, np.uint64))
    spread = (codes.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93)
    spread = (spread ^ (spread >> _U(32))) * weights
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])
    back = np.multiply.accumulate(np.full(len(codes), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    keys = (sums[ends] - sums[starts]) * back[starts]
    _, first, which = np.unique(keys + (ends - starts).astype(np.uint64), return_index=True, return_inverse=True)
    known = model.words
    counts = np.fromiter((known[joined[a:b]] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)), np.int64, len(first))
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[which])])
    cuts = np.searchsorted(starts, np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)]))
    return before[cuts[1:]] - before[cuts[:-1]]


def _groups(texts: list[str], most: int = 4_000_000):
    """Runs of texts of at most `most` characters, or one longer text."""
    run, size = [], 0
    for i, text in enumerate(texts):
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(i)
        size += len(text)
    if run:
        yield run


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row; a null text is empty.

    Texts with characters beyond the transducer's alphabet, or with what may be
    a special string, are counted by the tokenizer itself.
    """
    path = str(tokenizer or public_tokenizers.path("word_bpe_49k.json"))

    def run(batch):
        model = word_tokens(path)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        plain = [i for i, t in enumerate(texts) if t and _plain(t)]
        for group in _groups([texts[i] for i in plain]):
            own = [plain[i] for i in group]
            counts[own] = count_tokens([texts[i] for i in own], model)
        for i in set(range(len(texts))) - set(plain):
            counts[i] = model.count(texts[i]) if texts[i] else 0
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts.tolist(),
                "over_limit": (counts > limit).tolist()}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
