"""Languages of documents and of the segments of mixed documents."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import materialize
from . import ppm, segment
from .batches import map_texts, texts_of

LANGUAGES = ["en", "de", "fr", "es", "pt", "it", "nl", "ru"]
SAMPLE_PER_LANGUAGE = 2_000  # labelled records that the model is fitted on, at most about this many
FOREIGN_BITS = 60.0  # a sentence is foreign if its language saves this many bits against the text's
FOREIGN_BITS_PER_WORD = 4.0  # ... and this many a word

# Names of the languages besides their two-letter codes (ISO 639-2 and -3, English names).
NAMES = {
    "en": ["eng", "english"],
    "de": ["deu", "ger", "german"],
    "fr": ["fra", "fre", "french"],
    "es": ["spa", "spanish"],
    "pt": ["por", "portuguese"],
    "it": ["ita", "italian"],
    "nl": ["nld", "dut", "dutch"],
    "ru": ["rus", "russian"],
}


def normalized(label: Column) -> Column:
    """Two-letter code of a label in any spelling; null if it names none of LANGUAGES."""
    base = F.split(F.lower(F.trim(label)), "[-_]")[0]
    known = {name: code for code, names in NAMES.items() for name in [code, *names]}
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())])
    return F.try_element_at(table, base)


def fit(records: DataFrame, key: str = "record_id", text: str = "text", label: str = "meta.lang", per_language: int = SAMPLE_PER_LANGUAGE) -> ppm.Model:
    """Model from a bounded sample of labelled records.

    The sample takes each language's records by hash of the key; the label
    counts behind its rate come from all records.  As labels may be wrong, a
    first model relabels the sentences of the sample, and the second is fitted
    on those that agree with their record's label.  A language without labelled
    records can't be recognised, and without any such record no text has a language.
    """
    labelled = records.select(F.col(key).alias("key"), F.col(text).alias("text"), normalized(F.col(f"`{label}`")).alias("lang"))
    labelled = labelled.filter("lang is not null and text is not null and text != ''")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    if not sizes:
        return ppm.train({}, LANGUAGES)
    rate = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    sample = materialize(labelled.filter(share < rate[F.col("lang")]).select("lang", "text"), "sample")
    model = ppm.train(_collected(sample, None), LANGUAGES)
    return ppm.train(_collected(sample, sample.sparkSession.sparkContext.broadcast(model)), LANGUAGES)


def _collected(sample: DataFrame, model: Broadcast | None) -> dict[str, dict[str, int]]:
    """Word counts per language: of all sentences, or of those whose language by the model is the label."""

    def count(batch: pa.RecordBatch) -> dict:
        texts, labels = texts_of(batch), np.array(batch.column("lang").to_pylist())
        found: dict[tuple[str, str], int] = {}
        for a, b in segment.sub_batches(texts):
            layout = segment.Layout(texts[a:b])
            starts, ends = layout.words()
            words, of = layout.slices(starts, ends), layout.text_of(starts)
            keep = np.ones(len(words), dtype=bool)
            if model is not None and len(words):
                first = layout.sentence_starts()
                sentence = np.searchsorted(first, starts, side="right") - 1
                lines = model.value.sentences(layout)
                best = np.array(LANGUAGES)[lines["bits"].argmin(axis=1)]
                turn = np.flatnonzero(np.diff(sentence, prepend=-1))
                keep = np.repeat(best == labels[a:b][lines["text"]], np.diff(np.append(turn, len(words))))
            langs = labels[a:b][of]
            for lang, word, ok in zip(langs.tolist(), words, keep.tolist()):
                if ok:
                    pair = (lang, word.lower())
                    found[pair] = found.get(pair, 0) + 1
        return {
            "lang": pa.array([k[0] for k in found], pa.string()),
            "word": pa.array([k[1] for k in found], pa.string()),
            "n": pa.array(list(found.values()), pa.int64()),
        }

    counts = map_texts(sample.select("lang", "text"), count, "lang string, word string, n bigint")
    rows = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()  # all words of the bounded sample
    out: dict[str, dict[str, int]] = {}
    for lang, word, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "word", "n"))):
        out.setdefault(lang, {})[word] = n
    return out


def _segments(model: ppm.Model, texts: list, min_bits: float, min_word_bits: float) -> dict[str, np.ndarray]:
    """Maximal runs of sentences of one language: text, start, end, lang, confidence, main language of the text."""
    parts = []
    for a, b in segment.sub_batches(texts):
        layout = segment.Layout(texts[a:b])
        lines = model.sentences(layout)
        text, bits = lines["text"], lines["bits"]
        if not len(text) or not model.trained.any():
            continue
        total = np.zeros((b - a, bits.shape[1]))
        np.add.at(total, text, bits)
        main = total.argmin(axis=1)[text]
        best = bits.argmin(axis=1)
        saved = bits[np.arange(len(best)), main] - bits.min(axis=1)
        foreign = (saved >= min_bits) & (saved >= min_word_bits * lines["words"])
        lang = np.where(foreign, best, main)
        turn = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(lang, prepend=-1) != 0))
        last = np.append(turn[1:], len(text)) - 1
        run_bits = np.add.reduceat(bits, turn, axis=0)
        words = np.add.reduceat(lines["words"], turn)
        # Confidence: the language's share when each language's code length a word is read as a probability.
        mean = -run_bits / words[:, None]
        share = np.exp2(mean - mean.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        parts.append((text[turn] + a, lines["start"][turn], lines["end"][last], lang[turn], share[np.arange(len(turn)), lang[turn]], words, main[turn]))
    names = ("text", "start", "end", "lang", "confidence", "words", "main")
    if not parts:
        return {k: np.zeros(0, dtype=np.int64) for k in names}
    return {k: np.concatenate([p[i] for p in parts]) for i, k in enumerate(names)}


def segments(records: DataFrame, model: ppm.Model, key: str = "record_id", text: str = "text",
             min_bits: float = FOREIGN_BITS, min_word_bits: float = FOREIGN_BITS_PER_WORD) -> DataFrame:
    """(key, segment, start, end, lang, confidence, main): the segments of each row's text.

    start and end are offsets in characters, between segments lie wordless signs only; a segment is a maximal run of
    sentences of one language, and main says whether that is the language of most of the text.  A
    sentence leaves the text's language only if another one codes it with far
    fewer bits, so a borrowed phrase or a name changes nothing.  Null, blank and
    wordless texts have no segments; repeated rows have theirs each.
    """
    shared = records.sparkSession.sparkContext.broadcast(model)

    def cut(batch: pa.RecordBatch) -> dict:
        found = _segments(shared.value, texts_of(batch), min_bits, min_word_bits)
        of = found["text"]
        first = np.searchsorted(of, of, side="left")
        return {
            key: batch.column(key).take(pa.array(of)),
            "segment": pa.array(np.arange(len(of)) - first, pa.int32()),
            "start": pa.array(found["start"], pa.int64()),
            "end": pa.array(found["end"], pa.int64()),
            "lang": pa.array([LANGUAGES[i] for i in found["lang"]], pa.string()),
            "confidence": pa.array(found["confidence"], pa.float64()),
            "main": pa.array(found["lang"] == found["main"], pa.bool_()),
        }

    kind = records.schema[key].dataType.simpleString()
    source = records.select(key, F.col(text).alias("text"))
    return map_texts(source, cut, f"`{key}` {kind}, segment int, start bigint, end bigint, lang string, confidence double, main boolean")


def languages(records: DataFrame, model: ppm.Model, key: str = "record_id", text: str = "text", label: str = "meta.lang") -> DataFrame:
    """(key, label, lang, confidence, langs, mixed) of each row with words in its text.

    label is the normalized given label, lang the language of most of the text,
    langs all its languages in alphabetical order, mixed whether it has several.
    """
    shared = records.sparkSession.sparkContext.broadcast(model)

    def sum_up(batch: pa.RecordBatch) -> dict:
        found = _segments(shared.value, texts_of(batch), FOREIGN_BITS, FOREIGN_BITS_PER_WORD)
        of, lang = found["text"], found["lang"]
        pairs = np.unique(np.stack([of, lang]), axis=1) if len(of) else np.zeros((2, 0), dtype=np.int64)
        rows, first = np.unique(of, return_index=True)
        kinds: dict[int, list[str]] = {}
        for row, k in pairs.T.tolist():
            kinds.setdefault(row, []).append(LANGUAGES[k])
        main = found["main"][first] if len(of) else of
        own = lang == found["main"]
        weight = np.bincount(of[own], weights=found["words"][own], minlength=len(batch)) if len(of) else np.zeros(len(batch))
        share = np.bincount(of[own], weights=(found["confidence"] * found["words"])[own], minlength=len(batch)) if len(of) else weight
        return {
            key: batch.column(key).take(pa.array(rows)),
            "label": batch.column("label").take(pa.array(rows)),
            "lang": pa.array([LANGUAGES[i] for i in main], pa.string()),
            "confidence": pa.array((share / np.maximum(weight, 1))[rows], pa.float64()),
            "langs": pa.array([sorted(kinds[r]) for r in rows.tolist()], pa.list_(pa.string())),
            "mixed": pa.array([len(kinds[r]) > 1 for r in rows.tolist()], pa.bool_()),
        }

    kind = records.schema[key].dataType.simpleString()
    source = records.select(key, F.col(text).alias("text"), normalized(F.col(f"`{label}`")).alias("label"))
    return map_texts(source, sum_up, f"`{key}` {kind}, label string, lang string, confidence double, langs array<string>, mixed boolean")


def mislabelled(found: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, lang), distinct: all languages of the records whose label names no
    language or another than the text's, or whose text is mixed."""
    cases = found.filter("mixed or label is null or label != lang")
    return cases.select(key, F.explode("langs").alias("lang")).distinct()
