"""Model scores as columns: a registry of scorers over prompts.

A scorer is a factory, called once per task, that returns a function from a list
of prompts to a list of values.  All scorers of a request run in one
Arrow step, so texts cross to Python once.  Models are local files named by a
manifest; nothing is ever fetched.  A column whose model is missing is null.
``lexical`` has stand-ins for runs without any model: statistics of a text's
signs as JVM expressions, with the columns and types of the models but not their
values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import argmax, one_line, prompt
from ..plans.runtime import Meter

Scorer = Callable[[], Callable[[list], list]]


@dataclass(frozen=True)
class Output:
    """One score column: its Spark type, the prompt it reads and how it is made, by a factory or as an expression."""

    column: str
    kind: str
    factory: Scorer | None = None
    with_url: bool = False
    single_line: bool = False
    expression: Callable[[Column], Column] | None = None


@dataclass
class Registry:
    outputs: dict[str, Output] = field(default_factory=dict)

    def add(self, output: Output) -> None:
        if output.column in self.outputs:
            raise ValueError(f"{output.column} is registered already")
        self.outputs[output.column] = output


@dataclass(frozen=True)
class Contract:
    """What a column's model must give: Spark type, longest input in tokens, kind of result, prompt."""

    kind: str
    result: str
    max_tokens: int | None = None
    with_url: bool = False
    single_line: bool = False
    label: str | None = None


# The contracts of the six annotation columns.
CONTRACTS = {
    "TopicClassifier": Contract("bigint", "class", 8192, with_url=True),
    "FormatClassifier": Contract("bigint", "class", 8192, with_url=True),
    "fineweb_edu_classifier_score": Contract("float", "logit", 512),
    "jais_token_count": Contract("bigint", "tokens"),
    "fasttext_eli5_score": Contract("float", "label", single_line=True, label="__label__hq"),
    "fasttext_preselect_score": Contract("float", "label", single_line=True, label="__label__1"),
}
BATCH = 8  # prompts that a model reads at once



def score(df: DataFrame, registry: Registry, text: str = "text", url: str | None = None, columns: list[str] | None = None, meter: Meter | None = None) -> DataFrame:
    """df with a column per registered output (or of `columns`; names without a
    scorer become nulls of the column's type).  A null text scores null; older
    columns so named are replaced.  meter sums up the seconds of each scorer."""
    wanted = columns or list(registry.outputs)
    known = [registry.outputs[c] for c in wanted if c in registry.outputs]
    outputs = [o for o in known if o.factory is not None]
    body = F.col(f"`{text}`")

    def source(o: Output) -> Column:
        value = prompt(body, F.col(f"`{url}`") if url else F.lit("")) if o.with_url else body
        return one_line(value) if o.single_line else value

    cells = {o.column: o.expression(source(o)).cast(o.kind) for o in known if o.factory is None}
    cells |= {c: F.lit(None).cast(CONTRACTS[c].kind if c in CONTRACTS else "double") for c in wanted if c not in registry.outputs}
    df = df.drop(*wanted)
    if outputs:
        schema = ", ".join(f"`{o.column}` {o.kind}" for o in outputs)

        @F.pandas_udf(schema)
        def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            scorers = [o.factory() for o in outputs]
            for batch in batches:
                found = {}
                for o, scorer, prompts in zip(outputs, scorers, batch):
                    present = prompts.notna().to_numpy()
                    values = pd.Series([None] * len(prompts), dtype=object)
                    texts = list(prompts[present])
                    if texts and meter is not None:
                        with meter.timed(o.column):
                            values[present] = scorer(texts)
                    elif texts:
                        values[present] = scorer(texts)
                    found[o.column] = values
                yield pd.DataFrame(found)

        df = df.withColumn("_scores", run(*[source(o) for o in outputs]))
        cells |= {o.column: F.col("_scores")[o.column] for o in outputs}
    return df.withColumns({c: cells[c] for c in wanted}).drop("_scores")


def class_of(logits: Column) -> Column:
    """Class id of a vector of logits: the first maximum."""
    return argmax(logits).cast("bigint")


def column_of(model: str) -> str:
    """Column of a model's scores: what follows the last slash of its name, unless COLUMNS says otherwise."""
    return COLUMNS.get(model) or model.rpartition("/")[2]


# Models whose column isn't the last part of their name.
COLUMNS = {
    "HuggingFaceTB/fineweb-edu-classifier": "fineweb_edu_classifier_score",
    "core42/jais-13b": "jais_token_count",
    "mlfoundations/fasttext-oh-eli5": "fasttext_eli5_score",
    "hkust-nlp/preselect-fasttext-classifier": "fasttext_preselect_score",
}


def from_manifest(models: Mapping[str, Mapping]) -> Registry:
    """Scorers of the models of a manifest {model: {"kind", "path", "tokenizer", ...}}, by the contracts of their columns.

    kind is transformers (an ONNX file with a tokenizer file), tokenizer or
    fasttext.  Models without a path are left out, so their columns become null;
    an unknown kind or column is an error.
    """
    registry = Registry()
    for name, entry in models.items():
        if not entry.get("path"):
            continue
        column = column_of(name)
        if column not in CONTRACTS:
            raise ValueError(f"no contract for the column {column} of {name}")
        c = CONTRACTS[column]
        makers = {
            "transformers": lambda: transformer(entry["path"], entry["tokenizer"], c.max_tokens, c.result, entry.get("batch", BATCH)),
            "tokenizer": lambda: token_count(entry["path"]),
            "fasttext": lambda: fasttext(entry["path"], c.label),
        }
        if entry.get("kind") not in makers:
            raise ValueError(f"unknown kind of model: {entry.get('kind')}")
        registry.add(Output(column, c.kind, makers[entry["kind"]](), c.with_url, c.single_line))
    return registry


def transformer(path: str, tokenizer: str, max_tokens: int | None, result: str, batch: int = BATCH) -> Scorer:
    """A classifier in an ONNX file with inputs input_ids and perhaps attention_mask, and logits as its first output.

    The first max_tokens tokens are read, `batch` prompts at once, padded to the
    longest.  result is ``class`` (the first maximum) or ``logit`` (the first one).
    """

    def factory():
        import numpy as np
        import onnxruntime
        from tokenizers import Tokenizer

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1  # tasks share the cores
        session = onnxruntime.InferenceSession(path, options, providers=["CPUExecutionProvider"])
        inputs = {i.name for i in session.get_inputs()}
        reader = Tokenizer.from_file(tokenizer)
        reader.enable_padding()
        if max_tokens:
            reader.enable_truncation(max_tokens)

        def run(texts: list[str]) -> list:
            out = []
            for at in range(0, len(texts), batch):
                read = reader.encode_batch(texts[at : at + batch])
                feed = {"input_ids": np.array([e.ids for e in read], dtype=np.int64), "attention_mask": np.array([e.attention_mask for e in read], dtype=np.int64)}
                (logits, *_) = session.run(None, {k: v for k, v in feed.items() if k in inputs})
                logits = np.asarray(logits).reshape(len(read), -1)
                out += logits.argmax(axis=1).tolist() if result == "class" else logits[:, 0].astype(float).tolist()
            return out

        return run

    return factory


def token_count(tokenizer: str) -> Scorer:
    """Tokens of each whole text under a tokenizer file, and one for its end."""

    def factory():
        from tokenizers import Tokenizer

        reader = Tokenizer.from_file(tokenizer)
        return lambda texts: [len(e.ids) + 1 for e in reader.encode_batch(texts, add_special_tokens=False)]

    return factory


def fasttext(path: str, label: str) -> Scorer:
    """Probability of a label under a local fastText model; 0 if it isn't predicted."""

    def factory():
        import fasttext as library

        model = library.load_model(path)

        def run(texts):
            labels, shares = model.predict(texts, k=-1)
            return [float(dict(zip(names, p)).get(label, 0.0)) for names, p in zip(labels, shares)]

        return run

    return factory


# --- stand-ins -------------------------------------------------------------

CLASSES = 24


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _share(signs: str, top: float) -> Callable[[Column], Column]:
    return lambda text: _count(text, signs) * F.lit(top) / (1 + F.length(text))


def lexical() -> Registry:
    """Deterministic stand-ins for the six annotation columns, over whole texts."""
    r = Registry()
    r.add(Output("TopicClassifier", "bigint", with_url=True, expression=lambda text: F.length(text) % CLASSES))
    r.add(Output("FormatClassifier", "bigint", with_url=True, expression=lambda text: F.length(F.replace(text, F.lit("\n"), F.lit(""))) % CLASSES))
    r.add(Output("fineweb_edu_classifier_score", "float", expression=_share("bcdfgmpvw", 9.0)))
    r.add(Output("jais_token_count", "bigint", expression=lambda text: F.floor(F.length(text) / 4) + 1))
    r.add(Output("fasttext_eli5_score", "float", single_line=True, expression=_share("aeiou", 1.0)))
    r.add(Output("fasttext_preselect_score", "float", single_line=True, expression=_share("nrstl", 1.0)))
    return r
