"""Language by prediction by partial matching over bytes.

One variable-order context tree of bytes per language, frozen after training.
A byte is coded in its longest known context; where the context has not seen
the byte, an escape is paid and the context loses its first byte (escape method
C: d distinct bytes in t occurrences give the escape d / (t + d)).  The code
length of a text under a language is the exact sum of -log2 of these shares.

Contexts begin at the white space before a word, so the code length of a word
does not depend on its neighbours.  All languages are laid into one table from
context + byte to a vector of code lengths, and every distinct word is scored
once per worker: a sentence is a sum over rows of that table.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict

import numpy as np

from . import segment

ORDER = 5
CACHE_LIMIT = 400_000  # distinct words kept per worker, beyond which the cache starts anew


UNTRAINED = 1e6  # bits of any word under a language without training words


class Model:
    """Frozen code lengths, in bits, of each (context + byte) per language."""

    def __init__(self, languages: list[str], keys: list[bytes], bits: np.ndarray, contexts: list[bytes], escapes: np.ndarray, trained: np.ndarray):
        self.languages = list(languages)
        self.trained = trained
        self.keys, self.bits = keys, bits
        self.contexts, self.escapes = contexts, escapes
        self._index = self._escape = None

    def __getstate__(self):
        return self.__dict__ | {"_index": None, "_escape": None}

    def _open(self):
        if self._index is None:
            self._index = {k: i for i, k in enumerate(self.keys)}
            self._escape = {k: i for i, k in enumerate(self.contexts)}
            self.words: dict[str, int] = {}
            self.rows = np.zeros((1024, len(self.languages)), dtype=np.float32)

    def word_bits(self, word: str) -> np.ndarray:
        """Code length of one word, its end included, under each language."""
        self._open()
        coded = b" " + word.lower().encode("utf-8", "surrogatepass") + b" "
        total = np.zeros(len(self.languages))
        index, escape = self._index, self._escape
        for i in range(1, len(coded)):
            low = max(0, i - ORDER)
            while True:
                row = index.get(coded[low : i + 1])
                if row is not None:
                    total += self.bits[row]
                    break
                row = escape.get(coded[low:i])
                if row is not None:
                    total += self.escapes[row]
                if low == i:
                    total += 8.0  # unseen byte: one of 256
                    break
                low += 1
        total[~self.trained] = UNTRAINED
        return total

    def _word_rows(self, words: list[str]) -> np.ndarray:
        self._open()
        known = self.words
        found = list(map(known.get, words))
        if None in found:
            if len(known) > CACHE_LIMIT:
                known.clear()
                return self._word_rows(words)
            for i, row in enumerate(found):
                if row is None:
                    word = words[i]
                    row = known.get(word)
                    if row is None:
                        row = known[word] = len(known)
                        if row >= len(self.rows):
                            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
                        self.rows[row] = self.word_bits(word)
                    found[i] = row
        return np.fromiter(found, dtype=np.int64, count=len(found))

    def sentences(self, layout: segment.Layout) -> dict[str, np.ndarray]:
        """Of each sentence with a word: text, start, end, words, signs and bits per language."""
        first = layout.sentence_starts()
        starts, ends = layout.words()
        sentence = np.searchsorted(first, starts, side="right") - 1
        rows = self._word_rows(layout.slices(starts, ends))
        if not len(rows):
            empty = np.zeros(0, dtype=np.int64)
            return {"text": empty, "start": empty, "end": empty, "words": empty, "signs": empty, "bits": np.zeros((0, len(self.languages)))}
        turn = np.flatnonzero(np.diff(sentence, prepend=-1))
        used = sentence[turn]
        text = layout.text_of(first[used])
        end = np.minimum(np.append(first[1:], len(layout.code))[used], layout.text_end[text])
        return {
            "text": text,
            "start": first[used] - layout.text_start[text],
            "end": end - layout.text_start[text],
            "words": np.diff(np.append(turn, len(rows))),
            "signs": np.add.reduceat(ends - starts, turn),
            "bits": np.add.reduceat(self.rows[rows], turn, axis=0).astype(np.float64),
        }


def train(counts: dict[str, dict[str, int]], languages: list[str]) -> Model:
    """Model from word counts per language; one without words is never the best."""
    seen = [Counter() for _ in languages]
    for table, language in zip(seen, languages):
        for word, n in counts.get(language, {}).items():
            coded = b" " + word.encode("utf-8", "surrogatepass") + b" "
            for i in range(1, len(coded)):
                for low in range(max(0, i - ORDER), i + 1):
                    table[coded[low : i + 1]] += n
    size = len(languages)
    totals: dict[bytes, np.ndarray] = defaultdict(lambda: np.zeros(size))
    distinct: dict[bytes, np.ndarray] = defaultdict(lambda: np.zeros(size))
    union: dict[bytes, np.ndarray] = defaultdict(lambda: np.zeros(size))
    for k, table in enumerate(seen):
        for key, n in table.items():
            union[key][k] = n
            totals[key[:-1]][k] += n
            distinct[key[:-1]][k] += 1
    contexts = sorted(totals)
    total = np.array([totals[c] for c in contexts]).reshape(-1, size)
    kinds = np.array([distinct[c] for c in contexts]).reshape(-1, size)
    place = {c: i for i, c in enumerate(contexts)}
    with np.errstate(divide="ignore", invalid="ignore"):
        escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
    keys = sorted(union, key=lambda k: (len(k), k))
    row = {k: i for i, k in enumerate(keys)}
    bits = np.zeros((len(keys), size))
    lengths = [len(k) for k in keys]
    for length in sorted(set(lengths)):
        own = list(range(*_span(lengths, length)))
        n = np.array([union[keys[i]] for i in own])
        at = np.array([place[keys[i][:-1]] for i in own])
        shorter = np.full((len(own), size), 8.0) if length == 1 else bits[[row[keys[i][1:]] for i in own]]
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = -np.log2(n / (total[at] + kinds[at]))
        bits[own] = np.where(n > 0, direct, escapes[at] + shorter)
    return Model(languages, keys, bits.astype(np.float32), contexts, escapes.astype(np.float32), np.array([bool(t) for t in seen], dtype=bool))


def _span(lengths: list[int], length: int) -> tuple[int, int]:
    """Range of one length in a sorted list."""
    return bisect.bisect_left(lengths, length), bisect.bisect_right(lengths, length)
