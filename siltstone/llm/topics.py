"""Subject areas of documents by anchored non-negative factorisation.

The sentence-term matrix X is factored as W H with one component per subject,
anchored to it by labels, and one background component for the words that every
subject uses.  Rows are sentences rather than documents since a document deals
with a subject if two of its sentences do: a document's mixture is the sum of its
sentences' rows of W, and one stray sentence can't hide in it.  H is seeded with
what a subject's labelled texts use more often than the average text.  The
alternating multiplicative updates for the Kullback-Leibler divergence keep all
entries non-negative; W of a labelled text is zero outside its subjects and the
background, so a component can't drift to another subject.  One alternation is
one distributed pass: tasks update the rows of W with H fixed and send only their
sums for H.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import materialize
from . import segment
from .batches import map_texts, texts_of

SAMPLE = 30_000  # labelled records that the factorisation is fitted on, up to half of them fully labelled
ALTERNATIONS = 2
EXCESS = 2.0  # a subject's seed has a term's share above so many times its average share in the other subjects
SMOOTHING = 0.3
UPDATES = 3  # of W when texts are judged
TELLING = 0.02  # words with a smaller part of subjects are background
MIN_WORDS = 0.55  # a sentence is about a subject if so many of its words come from that component
MIN_SHARE = 0.6  # ... and so large a part of all that come from subjects
MIN_SENTENCES = 2


class Factor:
    """H as shares of the components in each term; row -1 stands for unknown terms."""

    def __init__(self, terms: list[str], weights: np.ndarray):
        self.terms, self.weights = terms, weights
        self._known = None

    def __getstate__(self):
        return self.__dict__ | {"_known": None}

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in weights, -1 if unknown; spellings are looked up once."""
        if self._known is None:
            self._known = {t: i for i, t in enumerate(self.terms)}
        known = self._known
        found = list(map(known.get, words))
        if None in found:
            if len(known) > 10 * len(self.terms) + 400_000:
                self._known = {t: i for i, t in enumerate(self.terms)}
                known = self._known
            for i, row in enumerate(found):
                if row is None:
                    word = words[i]
                    row = known.get(word.lower(), -1)
                    if len(word) <= 40:
                        known[word] = row
                    found[i] = row
        return np.fromiter(found, dtype=np.int64, count=len(found))


def _lines(texts: list) -> tuple[segment.Layout, np.ndarray, np.ndarray, list[str]]:
    """Layout, text of each sentence, sentence of each word, words."""
    layout = segment.Layout(texts)
    first = layout.sentence_starts()
    starts, ends = layout.words()
    return layout, layout.text_of(first), np.searchsorted(first, starts, side="right") - 1, layout.slices(starts, ends)


def _sample(records: DataFrame, labels: DataFrame, key: str, text: str, hint: str, areas: list[int], size: int) -> DataFrame:
    """(text, areas): bounded labelled rows, by hash of the key.

    Up to half of the size goes to records with complete labels, the rest to
    records with the single, sometimes wrong, class id.
    """
    share = F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) / float(1 << 20)
    full = labels.select(F.col(key).alias("_key"), "topic_id").filter(F.col("topic_id").isin(areas) & F.col("_key").isNotNull())
    n_full = full.agg(F.count_distinct("_key")).first()[0]
    full = full.filter(share < min(1.0, size / 2 / max(1, n_full))).groupBy("_key").agg(F.collect_set("topic_id").alias("_full"))
    rows = records.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.col(hint).cast("bigint").alias("_hint"))
    n_hint = rows.filter(F.col("_hint").isin(areas)).count()  # reads one column of numbers
    hinted = F.col("_hint").isin(areas) & (share < min(1.0, (size - min(n_full, size / 2)) / max(1, n_hint)))
    # `full` has at most about size / 2 rows of a few numbers each.
    rows = rows.filter("text is not null and text != ''").join(F.broadcast(full), "_key", "left").filter(F.col("_full").isNotNull() | hinted)
    return rows.select("text", F.coalesce("_full", F.array("_hint")).alias("areas"))


def fit(records: DataFrame, labels: DataFrame, areas: list[int], key: str = "record_id", text: str = "text",
        hint: str = "TopicClassifier", size: int = SAMPLE, alternations: int = ALTERNATIONS) -> Factor:
    """Factor from a bounded sample of labelled records (see the module).

    All terms of the sample are kept.  Without any labelled record the factor is
    empty and no text gets a subject.
    """
    sample = materialize(_sample(records, labels, key, text, hint, areas, size), "sample")
    terms, counts = _term_counts(sample, areas)
    if not terms:
        return Factor([], np.zeros((0, len(areas))))
    sums, factor = counts, Factor(terms, _seed(counts, len(areas)))
    for _ in range(alternations):
        sums = _alternation(sample, areas, factor)
        factor = Factor(terms, sums / np.maximum(sums.sum(axis=0, keepdims=True), 1e-9))
    amount = sums[:, :-1]
    amount = amount * (amount.sum() / len(areas) / np.maximum(amount.sum(axis=0), 1e-9))  # subjects count alike
    return Factor(terms, amount / (amount.sum(axis=1, keepdims=True) + sums[:, -1:] + SMOOTHING))


def _seed(counts: np.ndarray, areas: int) -> np.ndarray:
    """H of the first alternation: what a subject's texts use more often than the others', and the average text."""
    share = counts[:, :-1] / np.maximum(counts[:, :-1].sum(axis=0, keepdims=True), 1e-9)
    others = (share.sum(axis=1, keepdims=True) - share) / max(1, areas - 1)
    h = np.hstack([np.maximum(share - EXCESS * others, 0), share.mean(axis=1, keepdims=True)])
    return h / np.maximum(h.sum(axis=0, keepdims=True), 1e-9)


def _labelled(batch: pa.RecordBatch, place: dict[int, int]) -> tuple[list, np.ndarray]:
    """Texts, and which components each may have by its labels (the last one is the background)."""
    labels = batch.column("areas").to_pylist()
    allowed = np.zeros((len(labels), len(place) + 1))
    for i, ids in enumerate(labels):
        allowed[i, [place[a] for a in ids]] = 1
    return texts_of(batch), allowed


def _term_counts(sample: DataFrame, areas: list[int]) -> tuple[list[str], np.ndarray]:
    """The sample's terms, and how often each subject's texts use them; a text's words are shared among its subjects."""
    place, size = {a: i for i, a in enumerate(areas)}, len(areas) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, int] = {}
        table = np.zeros((1024, size))
        for batch in batches:
            texts, allowed = _labelled(batch, place)
            part = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
            for a, b in segment.sub_batches(texts):
                _, text, sentence, words = _lines(texts[a:b])
                row = np.fromiter((ids.setdefault(w.lower(), len(ids)) for w in words), dtype=np.int64, count=len(words))
                while len(table) < len(ids):
                    table = np.concatenate((table, np.zeros_like(table)))
                pair = row * (b - a) + text[sentence]
                pair, n = np.unique(pair, return_counts=True)
                np.add.at(table, pair // (b - a), part[a:b][pair % (b - a)] * n[:, None])
        if ids:
            columns = [pa.array(list(ids), pa.string()), *[pa.array(c, pa.float64()) for c in table[: len(ids)].T]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["term", *[f"c{k}" for k in range(size)]]
    sums = sample.mapInArrow(run, "term string, " + ", ".join(f"{c} double" for c in names[1:])).groupBy("term").agg(*[F.sum(c).alias(c) for c in names[1:]])
    found = sums.toArrow().sort_by("term")  # the sample's vocabulary
    return found.column("term").to_pylist(), np.stack([found.column(c).to_numpy() for c in names[1:]], axis=1) if len(found) else np.zeros((0, size))


def _alternation(sample: DataFrame, areas: list[int], factor: Factor) -> np.ndarray:
    """Sums for H, terms x components: each task updates its rows of W with H fixed and adds up a dense matrix."""
    place, size = {a: i for i, a in enumerate(areas)}, len(areas) + 1
    shared = sample.sparkSession.sparkContext.broadcast(factor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = shared.value
        total = np.zeros((len(h.terms), size))
        for batch in batches:
            texts, allowed = _labelled(batch, place)
            allowed[:, -1] = 1
            for a, b in segment.sub_batches(texts):
                _, text, sentence, words = _lines(texts[a:b])
                row = h.rows(words)
                keep = row >= 0
                row, sentence = row[keep], sentence[keep]
                part = _responsible(h.weights[row], sentence, allowed[a:b][text])
                order = np.argsort(row, kind="stable")
                turn = np.flatnonzero(np.diff(row[order], prepend=-1))
                if len(turn):
                    total[row[order][turn]] += np.add.reduceat(part[order], turn, axis=0)
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array(c, pa.float64()) for c in total[used].T]], names=names)

    names = ["row", *[f"c{k}" for k in range(size)]]
    sums = sample.mapInArrow(run, "row bigint, " + ", ".join(f"{c} double" for c in names[1:])).groupBy("row").agg(*[F.sum(c).alias(c) for c in names[1:]])
    found = sums.toArrow()  # at most one row a term
    out = np.zeros((len(factor.terms), size))
    out[found.column("row").to_numpy()] = np.stack([found.column(c).to_numpy() for c in names[1:]], axis=1)
    return out


def _responsible(h: np.ndarray, sentence: np.ndarray, allowed: np.ndarray, updates: int = 2) -> np.ndarray:
    """Part of each word that each component explains, after some updates of W."""
    w = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    turn = np.flatnonzero(np.diff(sentence, prepend=-1))
    part = h
    for _ in range(updates):
        part = w[sentence] * h
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-12)
        w = 0.05 * allowed
        if len(turn):
            w[sentence[turn]] += np.add.reduceat(part, turn, axis=0)
    return part


def _updated(h: np.ndarray, turn: np.ndarray, updates: int) -> np.ndarray:
    """W of each sentence: multiplicative updates from equal weights with H fixed.

    h has the subjects' shares of each word; the rest of a word belongs to the
    background, whose part is held.  turn has the first word of each sentence.
    """
    subject = h.sum(axis=1, keepdims=True)
    w = np.add.reduceat(h, turn, axis=0)
    length = np.diff(np.append(turn, len(h)))
    for _ in range(updates - 1):
        part = h * np.repeat(w, length, axis=0)
        part *= subject / np.maximum(part.sum(axis=1, keepdims=True), 1e-12)
        w = np.add.reduceat(part, turn, axis=0)
    return w


def mixtures(records: DataFrame, factor: Factor, areas: list[int], key: str = "record_id", text: str = "text", carry: list[str] = ()) -> DataFrame:
    """(key, topic_id, sentences, weight) of each row and subject with a sentence about it.

    W of each sentence comes from UPDATES multiplicative updates with H fixed.
    sentences counts those whose W is mostly one subject's, weight is the
    subject's part of the text's subject words.  Null and empty texts have no rows.
    """
    shared = records.sparkSession.sparkContext.broadcast(factor)
    ids = np.array(areas, dtype=np.int64)

    def fold(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        model = shared.value
        telling = np.append(model.weights.sum(axis=1) > TELLING, False)  # the last is that of unknown words
        of, area, number, weight = [], [], [], []
        for a, b in segment.sub_batches(texts):
            _, text, sentence, words = _lines(texts[a:b])
            row = model.rows(words)
            keep = telling[row]
            row, sentence = row[keep], sentence[keep]
            if not len(row):
                continue
            turn = np.flatnonzero(np.diff(sentence, prepend=-1))
            w = _updated(model.weights[row], turn, UPDATES)
            doc = text[sentence[turn]]
            best = w.argmax(axis=1)
            most, every = w.max(axis=1), w.sum(axis=1)
            about = (most >= MIN_WORDS) & (most >= MIN_SHARE * every)
            count = np.zeros((b - a, len(ids)), dtype=np.int64)
            np.add.at(count, (doc[about], best[about]), 1)
            total = np.zeros((b - a, len(ids)))
            np.add.at(total, doc, w)
            i, k = np.nonzero(count)
            of.append(i + a)
            area.append(ids[k])
            number.append(count[i, k])
            weight.append(total[i, k] / total[i].sum(axis=1))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        of = join(of, np.int64)
        return {
            key: batch.column(key).take(pa.array(of)),
            "topic_id": pa.array(join(area, np.int64), pa.int64()),
            "sentences": pa.array(join(number, np.int64), pa.int64()),
            "weight": pa.array(join(weight, np.float64), pa.float64()),
            **{c: batch.column(c).take(pa.array(of)) for c in carry},
        }

    kind = records.schema[key].dataType.simpleString()
    more = "".join(f", `{c}` {records.schema[c].dataType.simpleString()}" for c in carry)
    source = records.select(key, F.col(text).alias("text"), *carry)
    return map_texts(source, fold, f"`{key}` {kind}, topic_id bigint, sentences bigint, weight double{more}")


def subjects(mixture: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, topic_id), distinct: subjects with at least MIN_SENTENCES sentences."""
    return mixture.filter(F.col("sentences") >= MIN_SENTENCES).select(key, "topic_id").distinct()
