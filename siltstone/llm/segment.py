"""Vectorised text segmentation shared by the language-model operators.

A batch of texts is laid out as one array of codepoints; every boundary is
found with array operations, never with a regular expression:

* each codepoint is mapped to a class by one table lookup,
* runs of equal class come from comparing neighbours,
* state that a scanner would carry along is an associative scan: cumulative sums
  over boundary flags for counts, and for a finite automaton the composition of
  its transition functions (``scan``).

Texts are joined with a separator that has a class of its own, so no run, word
or sentence ever spans two texts.  Null and empty texts have no runs at all.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

LETTER, NUMBER, SPACE, OTHER, GAP = 0, 1, 2, 3, 4
SEPARATOR = "\x00"

# The code points with the Unicode property White_Space.
WHITE_SPACE = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Marks that end a sentence when white space or a line end follows.
SENTENCE_END = ".!?…。！？"
HEADING_DASH = 0x2014
CLOSING = "\"'”’»)]"
LINE_END = "\n\r\x0b\x0c\x85\u2028\u2029"

_tables: dict[bool, np.ndarray] = {}


def class_table(marks_are_letters: bool = False) -> np.ndarray:
    """Class of each codepoint; built once per worker process."""
    if marks_are_letters not in _tables:
        kind = {"L": LETTER, "N": NUMBER} | ({"M": LETTER} if marks_are_letters else {})
        category = unicodedata.category
        table = np.fromiter(
            (kind.get(category(chr(i))[0], OTHER) for i in range(sys.maxunicode + 1)),
            dtype=np.uint8,
            count=sys.maxunicode + 1,
        )
        table[WHITE_SPACE] = SPACE
        _tables[marks_are_letters] = table
    return _tables[marks_are_letters]


def sub_batches(texts, limit_chars: int = 400_000):
    """Split positions so that one layout holds about limit_chars characters.

    A single longer text is a batch of its own: texts are never cut.
    """
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit_chars:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def scan(functions: np.ndarray, first: int = 0, width: int = 64) -> np.ndarray:
    """State of an automaton before each element of a sequence.

    Row i of functions maps the state before element i to the one after it.
    Composition is associative: the sequence is cut into blocks, the functions of
    a block are composed for all blocks at once, the blocks' own functions are
    scanned in the same way, and a second pass fills in the states.
    """
    n, states = functions.shape
    if n <= width:
        out = np.empty(n, dtype=np.uint8)
        state = first
        for i, row in enumerate(functions.tolist()):
            out[i] = state
            state = row[state]
        return out
    blocks = -(-n // width)
    padded = np.empty((blocks * width, states), dtype=np.uint8)
    padded[:n] = functions
    padded[n:] = np.arange(states, dtype=np.uint8)
    padded = padded.reshape(blocks, width, states)
    composed = padded[:, 0]
    for k in range(1, width):
        composed = np.take_along_axis(padded[:, k], composed, axis=1)
    state = scan(composed, first, width)
    out = np.empty((blocks, width), dtype=np.uint8)
    line = np.arange(blocks)
    for k in range(width):
        out[:, k] = state
        state = padded[line, k, state]
    return out.reshape(-1)[:n]


def _codes(signs: str) -> np.ndarray:
    return np.frombuffer(signs.encode("utf-32-le"), dtype=np.uint32)


class Layout:
    """Codepoints and classes of a batch of texts (None counts as empty)."""

    def __init__(self, texts, marks_are_letters: bool = False):
        self.count = len(texts)
        parts = [t or "" for t in texts]
        self.joined = SEPARATOR.join(parts) + SEPARATOR
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.text_end = np.cumsum(lengths + 1) - 1  # place of each text's separator
        self.text_start = self.text_end - lengths
        self.code = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.cls = class_table(marks_are_letters)[self.code]
        self.cls[self.text_end] = GAP
        turns = np.ones(len(self.cls), dtype=bool)
        np.not_equal(self.cls[1:], self.cls[:-1], out=turns[1:])
        turns[self.text_end] = True  # neighbouring separators (empty texts) are runs of their own
        self.run_start = np.flatnonzero(turns)
        self.run_end = np.append(self.run_start[1:], len(self.code))
        self.run_cls = self.cls[self.run_start]

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """Index of the text that holds each position."""
        return np.searchsorted(self.text_end, positions, side="left")

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        joined = self.joined
        return [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the letter runs."""
        keep = self.run_cls == LETTER
        return self.run_start[keep], self.run_end[keep]

    def sentence_starts(self) -> np.ndarray:
        """Sorted first positions of sentences: text starts, places after line
        ends, places after a closing mark with white space behind it, and the
        dash that sets off a text's heading in its first line."""
        signs = np.flatnonzero((self.cls == SPACE) | (self.cls == OTHER))
        code, n = self.code, len(self.code)
        sign = code[signs]
        ends = signs[np.isin(sign, _codes(LINE_END))]
        marks = signs[np.isin(sign, _codes(SENTENCE_END))]
        after = np.minimum(marks + 1, n - 1)
        after = np.where(np.isin(code[after], _codes(CLOSING)), np.minimum(after + 1, n - 1), after)
        real = after[self.cls[after] == SPACE]
        flags = np.zeros(n, dtype=bool)
        flags[self.text_start] = flags[ends + 1] = flags[real] = True
        starts = np.flatnonzero(flags)
        dash = signs[(sign == HEADING_DASH) & (self.cls[np.minimum(signs + 1, n - 1)] == SPACE)]
        if len(dash):
            text, first = np.unique(self.text_of(dash), return_index=True)
            dash = dash[first]
            heading = starts[np.searchsorted(starts, dash, side="right") - 1] == self.text_start[text]
            starts = np.union1d(starts, dash[heading])
        return starts
