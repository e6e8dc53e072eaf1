"""Byte-level BPE with a public vocabulary, vectorised over batches of texts.

Pre-tokenisation finds all boundaries of the pattern of byte-level BPE
(contractions; words, numbers and other signs with one leading space; white
space) from arrays of codepoint classes, see ``segment``.  Every distinct slice
goes through pair merging once per worker and is then served from a cache.
"""

from __future__ import annotations

import base64
import heapq
import os
from dataclasses import dataclass
from itertools import chain

import numpy as np

from . import segment

VOCABULARY_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")  # a parameter of every function that reads it
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
CACHE_LIMIT = 400_000  # distinct slices kept per worker
KEPT_SLICE = 64  # longer slices hardly repeat and aren't kept

# The contractions that stand alone, without their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


FRESH, JOINED = 0, 1  # a slice starts with the run, or began with the space before it; beyond: signs of the run that a contraction took


def _prefix_of(layout: segment.Layout, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Letters of the contraction behind the apostrophe at each place, 0 if there is none."""
    found = np.zeros(len(at), dtype=np.int64)
    pad = np.concatenate((layout.code, np.zeros(3, dtype=np.uint32)))
    for mark in CONTRACTIONS:
        hit = limit - at > len(mark)
        for k, sign in enumerate(mark):
            hit &= pad[at + 1 + k] == ord(sign)
        found[hit] = len(mark)
    return found


def piece_bounds(layout: segment.Layout) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all slices of a layout, in order.

    The scanner is an automaton over runs of equal class.  White space gives its
    last sign to the next run, which a plain space joins; a lone apostrophe that no
    space has joined can take the first letters of the next run.  The state
    before each run comes from a scan over the runs' transition functions.
    """
    code, start, end, cls = layout.code, layout.run_start, layout.run_end, layout.run_cls
    n, after = len(start), np.append(cls[1:], segment.GAP)
    space = (cls == segment.SPACE) & (after != segment.GAP)
    plain = space & (code[end - 1] == 32)
    lone = np.flatnonzero((cls == segment.OTHER) & (end - start == 1) & (after == segment.LETTER))
    lone = lone[code[start[lone]] == 39]
    took = np.zeros(n, dtype=np.int64)
    took[lone] = _prefix_of(layout, start[lone], end[np.minimum(lone + 1, n - 1)])
    longest = max(map(len, CONTRACTIONS))
    functions = np.zeros((n, JOINED + 1 + longest), dtype=np.uint8)
    functions[plain] = JOINED
    bound = took > 0
    functions[bound, FRESH] = JOINED + took[bound]
    state = segment.scan(functions)
    flags = np.zeros(len(code) + 1, dtype=bool)
    flags[start[(state == FRESH)]] = True
    flags[end[space] - 1] = True
    given = state > JOINED  # the contraction's letters belong to the apostrophe's slice
    rest = start[given] + state[given] - JOINED
    flags[rest] = True
    starts = np.flatnonzero(flags[:-1])
    ends = np.append(starts[1:], len(code))
    real = layout.cls[starts] != segment.GAP
    return starts[real], ends[real]


@dataclass
class Encoded:
    """ids of some texts: text i has ids[offsets[i]:offsets[i + 1]], and slice j starts at
    character slice_start[j] of its text and has slice_ids[j] ids."""

    ids: np.ndarray
    offsets: np.ndarray
    slice_start: np.ndarray
    slice_ids: np.ndarray

    def id_starts(self) -> np.ndarray:
        """For each id the character at which its slice begins."""
        return np.repeat(self.slice_start, self.slice_ids)


class ByteBPE:
    """Encoder for a vocabulary given as ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: always join the pair of lowest rank, leftmost first."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        part = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or part[i] + part[j] != both:
                continue  # one of the two has been joined since
            part[i], part[j] = both, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(both + part[k])) is not None:
                    heapq.heappush(heap, (r, i, both + part[k]))
            if (h := before[i]) >= 0 and (r := ranks.get(part[h] + both)) is not None:
                heapq.heappush(heap, (r, h, part[h] + both))
        return tuple(ranks[p] for p in part if p is not None)

    def _ids(self, pieces: list[str]) -> list[tuple[int, ...]]:
        cache = self.cache
        found = list(map(cache.get, pieces))
        if None in found:
            if len(cache) > CACHE_LIMIT:
                cache.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    ids = cache.get(piece)
                    if ids is None:
                        ids = self.merge(piece.encode("utf-8", "surrogatepass"))
                        if len(piece) <= KEPT_SLICE:
                            cache[piece] = ids
                    found[i] = ids
        return found

    def encoded(self, texts) -> Encoded:
        """The ids of each text with the places of its slices; none if null or empty."""
        parts = [(np.zeros(0, dtype=np.int32),) + (np.zeros(0, dtype=np.int64),) * 3]
        for a, b in segment.sub_batches(texts):
            layout = segment.Layout(texts[a:b])
            starts, ends = piece_bounds(layout)
            found = self._ids(layout.slices(starts, ends))
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ids = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum()))
            text = layout.text_of(starts)
            counts = np.bincount(text, weights=lengths, minlength=b - a)
            parts.append((ids, counts.astype(np.int64), starts - layout.text_start[text], lengths))
        ids, counts, starts, lengths = (np.concatenate(p) for p in zip(*parts))
        return Encoded(ids, np.concatenate(([0], np.cumsum(counts))), starts, lengths)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i]:offsets[i + 1]]."""
        found = self.encoded(texts)
        return found.ids, found.offsets

    def count(self, texts) -> np.ndarray:
        """Number of ids of each text, 0 if null or empty."""
        return np.diff(self.encode(texts)[1])

    def decode(self, ids) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")

    def decode_between(self, ids, starts, low: int, high: int) -> str:
        """What the slices of a text hold that begin at characters low to high - 1, from its ids and their starts."""
        a, b = np.searchsorted(np.asarray(starts), (low, high))
        return self.decode(ids[a:b])


_loaded: dict[tuple[str, str], ByteBPE] = {}


def load(name: str = BYTE_BPE_50K, folder: str = VOCABULARY_DIR) -> ByteBPE:
    """The encoder of a vocabulary file, loaded once per worker process."""
    if (folder, name) not in _loaded:
        ranks = {}
        with open(os.path.join(folder, name), "rb") as lines:
            for line in lines:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        _loaded[folder, name] = ByteBPE(ranks)
    return _loaded[folder, name]
