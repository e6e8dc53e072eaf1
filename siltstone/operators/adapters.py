"""Stable types for records of collections whose values vary in type.

An adapter declares the Spark type of each column and a coercion per value.  JSON
tells integers from fractions and strings value by value, which a DataFrame's
inferred schema does not keep, so records are parsed and coerced in one
vectorised Python step; everything after it is typed.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Coerce = Callable[[object], object]


def missing(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v))


def as_int(v):
    """Integers (booleans are 0 and 1) stay; anything else is null."""
    return int(v) if isinstance(v, int) else None


def as_float(v):
    return float(v) if isinstance(v, (int, float)) else None


def only_str(v):
    return v if isinstance(v, str) else None


def scalar_str(v):
    """Strings and numbers as text; null, NaN, lists and objects are null."""
    if missing(v) or not isinstance(v, (str, int, float)):
        return None
    return str(v)


def parsed_int(v):
    """Integers, fractions without a fractional part and strings that spell an integer."""
    if isinstance(v, int):
        return int(v)
    if isinstance(v, float) and math.isfinite(v) and v == int(v):
        return int(v)
    if isinstance(v, str):
        try:
            return int(v.strip())
        except ValueError:
            return None
    return None


def any_str(v):
    """Anything as text: lists joined by bars (null items empty), objects as sorted JSON; null and NaN are null."""
    if missing(v) or isinstance(v, str):
        return None if missing(v) else v
    if isinstance(v, list):
        return " | ".join("" if e is None else str(e) for e in v)
    if isinstance(v, (int, float)):
        return str(v)
    return json.dumps(v, ensure_ascii=False, sort_keys=True)


def each(item: Coerce) -> Coerce:
    """Lists item by item; anything else is null."""
    return lambda v: [item(x) for x in v] if isinstance(v, list) else None


def nested_ints(depth: int) -> Coerce:
    """Lists of lists down to integers; null at any level stays, another kind of
    value above the last level makes the whole null."""

    def run(v, level):
        if level == 0:
            return as_int(v)
        if missing(v):
            return None
        if not isinstance(v, list):
            raise TypeError
        return [run(x, level - 1) for x in v]

    def coerce(v):
        try:
            return run(v, depth)
        except TypeError:
            return None

    return coerce


def record(parts: dict[str, Coerce]) -> Coerce:
    """Objects part by part, absent ones null; anything else is null."""
    return lambda v: {k: c(v.get(k)) for k, c in parts.items()} if isinstance(v, dict) else None


@dataclass(frozen=True)
class Adapter:
    """Types and coercions of the columns of one collection.

    ``rest`` types all other ``meta.*`` columns of the schema given to ``apply``.
    """

    name: str
    columns: dict[str, tuple[str, Coerce]] = field(default_factory=dict)
    rest: tuple[str, Coerce] | None = None

    def rule(self, column: str) -> tuple[str, Coerce] | None:
        if column in self.columns:
            return self.columns[column]
        return self.rest if self.rest and column.startswith("meta.") else None


_text = {"string": ("string", scalar_str)}
_media = ("array<int>", each(lambda v: None if missing(v) else as_int(v)))
_dups = lambda to_int: ("struct<dup_doc_count:bigint>", record({"dup_doc_count": to_int}))
_strings = lambda names: {f"meta.{n}": ("string", scalar_str) for n in names}

HPLT = Adapter("hplt", {
    "meta.hplt_attr": (
        "struct<c:string,collection:string,doc_scores:array<double>,f:string,filter:string,o:bigint,"
        "pii:array<array<array<bigint>>>,prob:array<double>,robotstxt:string,rs:bigint,s:bigint,seg_langs:array<string>,ts:string>",
        record({
            "c": only_str, "collection": only_str, "doc_scores": each(as_float), "f": only_str, "filter": only_str, "o": as_int,
            "pii": nested_ints(3), "prob": each(as_float), "robotstxt": only_str, "rs": as_int, "s": as_int,
            "seg_langs": each(only_str), "ts": only_str,
        }),
    ),
})
S2ORC = Adapter("s2orc", {
    "meta.openaccessinfo": (
        "struct<externalids:struct<ACL:string,ArXiv:string,DOI:string,MAG:string,PubMedCentral:string>,license:string,status:string,url:string>",
        record({
            "externalids": record(dict.fromkeys(["ACL", "ArXiv", "DOI", "MAG", "PubMedCentral"], scalar_str)),
            "license": scalar_str, "status": scalar_str, "url": scalar_str,
        }),
    ),
})
MEGAMATH = Adapter("megamath", {
    "meta.media": _media, "meta.dup_signals": _dups(as_int),
    "meta.lang_score": ("double", as_float), "meta.math_score": ("double", as_float),
    "meta.token_count": ("bigint", as_int), "meta.minhash_cluster_id": ("bigint", as_int),
    **_strings(["lang", "url", "timestamp", "cc-path", "domain", "file_path", "data_label"]),
})
PHILPAPERS = Adapter("philpapers", {
    "meta.media": _media, "meta.dup_signals": _dups(as_int),
    **_strings(["title", "type", "creator", "subject", "date", "identifier", "description", "datestamp", "file_path", "data_label"]),
})
USPTO = Adapter("uspto", {
    "meta.dup_signals": _dups(parsed_int),
    **{f"meta.{n}": ("bigint", parsed_int) for n in ("token_count", "minhash_cluster_id", "data_rank")},
    "text": ("string", any_str), "subset": ("string", any_str),
}, rest=("string", any_str))

ADAPTERS = [HPLT, S2ORC, MEGAMATH, PHILPAPERS, USPTO]
# Parts of a path, in lower case, that name a collection; the first that occurs counts.
PATH_PARTS = [("hplt", "hplt"), ("s2orc", "s2orc"), ("megamath", "megamath"), ("phil_papers", "philpapers"),
              ("phil-papers", "philpapers"), ("philpapers", "philpapers"), ("uspto", "uspto")]


def choose(path: str) -> Adapter | None:
    """The adapter whose collection a path names."""
    low = path.lower()
    name = next((n for part, n in PATH_PARTS if part in low), None)
    return next((a for a in ADAPTERS if a.name == name), None)


def choice(path: Column) -> Column:
    """Name of the adapter of a path column, null if it names none."""
    low = F.lower(path)
    return F.coalesce(*[F.when(F.contains(low, F.lit(part)), F.lit(name)) for part, name in PATH_PARTS])


def _flat_for(value: dict, columns: set[str]) -> dict:
    """One level of objects opened to ``parent.child``, later duplicates win; objects that a declared column takes whole stay whole."""
    out = {}
    for k, v in value.items():
        if isinstance(v, dict) and k not in columns:
            out.update((f"{k}.{c}", x) for c, x in v.items())
        else:
            out[k] = v
    return out


def apply(df: DataFrame, adapter: Adapter, line: str = "line", extra: tuple[str, ...] = ("text", "subset"), more: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of JSON lines: the adapter's, ``extra`` as strings, and further
    ``more`` columns under the adapter's rest rule.

    Values are coerced one by one, so an odd value never changes its neighbours.
    Lines that are no JSON objects are an error.  Other columns of df are kept
    unless their names clash with the typed ones.
    """
    rules: dict[str, tuple[str, Coerce]] = {c: ("string", only_str) for c in extra}
    rules |= adapter.columns
    rules |= {c: adapter.rule(c) or ("string", scalar_str) for c in more if c not in rules}
    names = set(rules)
    keep = [f for f in df.schema.fields if f.name != line and f.name not in rules]
    schema = T.StructType(keep + [T.StructField(n, T._parse_datatype_string(kind)) for n, (kind, _) in rules.items()])
    kept = [f.name for f in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells: dict[str, list] = {n: [] for n in rules}
            for text in batch[line]:
                value = json.loads(text)
                if not isinstance(value, dict):
                    raise ValueError("a line holds no JSON object")
                own = _flat_for(value, names)
                for n, (_, coerce) in rules.items():
                    cells[n].append(coerce(own.get(n)))
            out = batch[kept].copy()
            for n, values in cells.items():
                out[n] = pd.Series(values, dtype=object, index=out.index)
            yield out

    return df.mapInPandas(run, schema)
