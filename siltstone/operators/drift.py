"""Schemas that drift between the files of a feed.

Lines are parsed in parallel and each task sends one small profile per file and
field: how often each JSON type occurs and a sketch of the content.  Profiles of
a file are added up; a field's type in a file is that of most of its values, so
single odd values change nothing.  The types of successive files are compared
and promoted to the least type of a lattice that holds both (``promote``): a
field is retyped where its old and new type differ, and the log names the
promoted type.  Folded over all files the lattice gives the union schema, which
the lines are cast to.

A field is a top-level key, or ``meta.x`` for key x in the object ``meta`` and for
a top-level key spelled that way.  Lines that are null, blank, broken or no JSON
objects have no fields; of a key that is given twice in a line the last value
counts; files without any valid line are skipped.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.lineage import broadcast_if_small, materialize
from .joins import spread_join

# The promotion lattice: a type's bit set holds all types it can be cast to without loss.
TYPES = ["boolean", "integer", "number", "array", "object", "string"]
PROMOTES = {
    "boolean": {"boolean", "string"},
    "integer": {"integer", "number", "string"},
    "number": {"number", "string"},
    "array": {"array", "string"},
    "object": {"object", "string"},
    "string": {"string"},
}
SPARK_TYPES = {"boolean": "boolean", "integer": "bigint", "number": "double", "array": "string", "object": "string", "string": "string"}

SKETCH = 64  # hashed character trigrams kept of a field's content
SAME_CONTENT = 0.3  # similarity at which a vanished and a new field are one renamed field
CANONICAL = {"text": "string", "subset": "string", "meta.token_count": "bigint", "meta.lang": "string"}

# Sums that describe a field's content, besides the sketch.
MEASURES = ["values", "numeric", "whole", "log_value", "log_value2", "length", "length2", "spaces", "digits", "letters", "upper", "multi"]
COUNTS = ["lines", "nulls", *[f"{t}_n" for t in TYPES]]
CELLS = [f"cell_{i}" for i in range(SKETCH)]
CELL_UNIT = 1024  # the share of a value's trigrams in a cell is counted in so many parts, so that sums are whole numbers
HELD_PROFILES = 20_000  # profiles that a task holds; when there are more, they are sent on and added up later
SCHEMA = "feed string, file_no int, field string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", " + ", ".join(
    f"{m} double" for m in MEASURES
) + ", " + ", ".join(f"{c} bigint" for c in CELLS)


def promote(a: str, b: str) -> str:
    """The least type of the lattice that both types can be cast to."""
    both = PROMOTES[a] & PROMOTES[b]
    return min(both, key=lambda t: (-len(PROMOTES[t]), TYPES.index(t)))


def merged(a: str | None, b: str | None) -> str | None:
    """promote, where an unknown type (no values) leaves the other."""
    return promote(a, b) if a and b else a or b


def kind(value) -> str:
    """JSON type of a non-null value; a number is what is written with a point or exponent."""
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, float):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def parse(line: str | None) -> dict | None:
    """The object of a line, or None if it is no valid JSON object."""
    if not line or line.isspace():
        return None
    try:
        value = json.loads(line, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def fields(record: dict) -> dict:
    """Fields of a record; an object (or null) under ``meta`` is opened and is no field itself."""
    out = {}
    for key, value in record.items():
        if key == "meta" and (value is None or isinstance(value, dict)):
            out.update((f"meta.{k}", v) for k, v in (value or {}).items())
        else:
            out[key] = value
    return out


def content(value) -> str | None:
    """The text that a value carries, None if it is null or empty inside.

    A list carries its parts, joined by spaces; an object its longest string that
    is no number (of a code with a score the code, of a message what it says),
    or else its longest scalar.
    """
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, dict):
        parts = [p for p in map(content, value.values()) if p]
        return max([p for p in parts if not _NUMBER.fullmatch(p)] or parts, key=len, default=None)
    if isinstance(value, list):
        parts = [p for p in map(content, value) if p]
        return " ".join(parts) if parts else None
    return json.dumps(value)


_NUMBER = re.compile(r"\s*-?\d+(\.\d+)?([eE][-+]?\d+)?\s*")


_classes: list[np.ndarray] = []


def _sign_classes() -> list[np.ndarray]:
    """Tables over the first 65,536 code points: digits, letters, upper case; built once a worker."""
    if not _classes:
        signs = [chr(i) for i in range(0x10000)]
        _classes.extend(np.array([f(c) for c in signs] + [False]) for f in (str.isdigit, str.isalpha, str.isupper))
    return _classes


def measured(texts: list[str], group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of MEASURES over the values of each group, and the cells of the sketches
    of their character trigrams, each value weighing the same."""
    if not texts:
        return np.zeros((groups, len(MEASURES))), np.zeros((groups, SKETCH), dtype=np.int64)
    code = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    start = np.cumsum(n + 2) - n - 2
    total = np.maximum(n, 1)
    share = lambda flags: np.add.reduceat(flags.astype(np.int64), start) / total
    capped = np.minimum(code, 0x10000)
    spaces = (np.add.reduceat((code == 32).astype(np.int64), start) - 2) / total
    size = np.log1p(n)
    numeric = np.fromiter((_NUMBER.fullmatch(t) is not None for t in texts), dtype=bool, count=len(texts))
    value = np.zeros(len(texts))
    value[numeric] = [max(-1e300, min(1e300, float(t))) for t, ok in zip(texts, numeric.tolist()) if ok]
    logs = np.copysign(np.log1p(np.abs(value)), value)
    digits, letters, upper = (share(t[capped]) for t in _sign_classes())
    multi = np.fromiter((" " in t.strip() for t in texts), dtype=bool, count=len(texts))
    every = [np.ones(len(texts)), numeric, numeric & (value == np.trunc(value)), logs, logs * logs, size, size * size, spaces, digits, letters, upper, multi]
    sums = np.stack([np.bincount(group, weights=v, minlength=groups) for v in every], axis=1)
    hashed = (code[:-2] * 961 + code[1:-1] * 31 + code[2:]) * 0x9E3779B1 % 0x100000000 // (0x100000000 // SKETCH)
    inside = np.ones(len(code), dtype=bool)
    ends = start + n + 2
    inside[ends - 1] = inside[ends - 2] = False
    inside = inside[:-2]
    owner = np.repeat(group, n + 2)[:-2]
    weight = np.repeat(1 / total, n + 2)[:-2]
    cells = np.bincount((owner * SKETCH + hashed)[inside], weights=weight[inside], minlength=groups * SKETCH)
    return sums, np.rint(cells * CELL_UNIT).astype(np.int64).reshape(groups, SKETCH)


def _profiled(rows: Iterable[tuple[str, int, str]]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Keys (feed, file_no, field) of some lines with their COUNTS, MEASURES and CELLS."""
    keys: dict[tuple, int] = {}
    of, kinds, texts, owners = [], [], [], []
    for feed, file_no, line in rows:
        record = parse(line)
        if record is None:
            continue
        for name, value in fields(record).items():
            k = keys.setdefault((feed, file_no, name), len(keys))
            of.append(k)
            if value is None:
                kinds.append(0)
            else:
                kinds.append(1 + TYPES.index(kind(value)))
                texts.append(content(value) or "")
                owners.append(k)
    size = 1 + len(TYPES)
    table = np.bincount(np.array(of, dtype=np.int64) * size + np.array(kinds, dtype=np.int64), minlength=len(keys) * size).reshape(-1, size)
    counts = np.hstack([table.sum(axis=1, keepdims=True), table]).astype(np.int64)
    return list(keys), counts, *measured(texts, np.array(owners, dtype=np.int64), len(keys))


def profiles(lines: DataFrame) -> DataFrame:
    """One row per file and field with the columns of SCHEMA, over all lines of
    (feed, file_no, line); a file delivered twice counts twice in all of them."""

    def batch_of(held: dict) -> pa.RecordBatch:
        keys = list(held)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string())]
        for part, type_of in enumerate((pa.int64(), pa.float64(), pa.int64())):
            columns += [pa.array(c, type_of) for c in np.array([v[part] for v in held.values()]).T]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            keys, *parts = _profiled(zip(*(batch.column(c).to_pylist() for c in ("feed", "file_no", "line"))))
            for key, *own in zip(keys, *parts):
                held[key] = [a + b for a, b in zip(held[key], own)] if key in held else own
            if len(held) > HELD_PROFILES:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    source = lines.select("feed", F.col("file_no").cast("int").alias("file_no"), "line").filter("feed is not null and file_no is not null")
    # Spread by file: what follows groups by file or by file and field, and needs no further exchange.
    return source.mapInArrow(scan, SCHEMA).repartition("feed", "file_no").groupBy("feed", "file_no", "field").agg(*[F.sum(c).alias(c) for c in _NAMES[3:]])


_NAMES = ["feed", "file_no", "field", *COUNTS, *MEASURES, *CELLS]


def _sketch() -> Column:
    return F.array(*[F.col(c).cast("float") for c in CELLS]).alias("sketch")


def packed(profile: DataFrame) -> DataFrame:
    """(feed, file_no, fields): the typed profiles of each file in one row, the sketches as arrays."""
    one = F.struct("field", "type", *MEASURES, _sketch())
    return typed(profile).groupBy("feed", "file_no").agg(F.collect_list(one).alias("fields"))


def typed(profile: DataFrame) -> DataFrame:
    """profile with ``type``, that of most non-null values (null if there are none;
    ties go to the earlier of TYPES)."""
    most = F.greatest(*[F.col(f"{t}_n") for t in TYPES])
    pick = F.coalesce(*[F.when((F.col(f"{t}_n") == most) & (most > 0), F.lit(t)) for t in TYPES])
    return profile.withColumn("type", pick)


def similarity(a, b) -> float:
    """How alike two profiles' contents are, 0 to 1; a and b map column names to values."""
    na, nb = a["values"], b["values"]
    if not na or not nb:
        return 0.0
    ma, mb = ({m: x[m] / x["values"] for m in MEASURES} for x in (a, b))
    spread = lambda m, s: math.sqrt(max(0.0, m[f"{s}2"] - m[s] ** 2))
    numeric_a, numeric_b = ma["numeric"] > 0.5, mb["numeric"] > 0.5
    if numeric_a != numeric_b:
        return 0.0
    if numeric_a:
        da, db = spread(ma, "log_value"), spread(mb, "log_value")
        gap = abs(ma["log_value"] - mb["log_value"]) / (0.35 + max(da, db))
        shape = abs(math.log((da + 0.05) / (db + 0.05)))  # a constant isn't a measured quantity
        return math.exp(-0.7 * gap - 0.6 * max(0.0, shape - 0.7)) * (1 - 0.8 * abs(ma["whole"] - mb["whole"]))
    sa, sb = np.asarray(a["sketch"], dtype=np.float64), np.asarray(b["sketch"], dtype=np.float64)
    dot, norm = float(sa @ sb), math.sqrt(float(sa @ sa) * float(sb @ sb))
    gap = abs(ma["length"] - mb["length"]) / (0.5 + max(spread(ma, "length"), spread(mb, "length")))
    signs = sum(abs(ma[m] - mb[m]) for m in ("spaces", "digits", "letters", "upper")) + 0.5 * abs(ma["multi"] - mb["multi"])
    return (dot / norm if norm else 0.0) * math.exp(-0.4 * gap - 1.5 * signs)


def _plain(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.removeprefix("meta.").lower())


def renames(gone: list[dict], new: list[dict]) -> list[tuple[str, str]]:
    """(old, new) pairs of fields with the same content, each field used once, the
    most alike first.  Names that differ by case, underscores or ``meta.`` alone
    need less alike contents."""
    pairs = []
    for a in gone:
        for b in new:
            alike = similarity(a, b)
            if _plain(a["field"]) == _plain(b["field"]):
                alike = max(alike, 0.5) + 1
            if alike >= SAME_CONTENT:
                pairs.append((-alike, a["field"], b["field"]))
    out, used = [], set()
    for _, old, name in sorted(pairs):
        if ("a", old) not in used and ("b", name) not in used:
            used |= {("a", old), ("b", name)}
            out.append((old, name))
    return out


def _differences(prev: list[dict], cur: list[dict]) -> list[tuple[str, str, str | None, str | None, str | None, str | None]]:
    """(change, field, before, old type, new type, promoted type) from one file to the next."""
    a, b = {p["field"]: p for p in prev}, {p["field"]: p for p in cur}
    pairs = renames([p for k, p in sorted(a.items()) if k not in b], [p for k, p in sorted(b.items()) if k not in a])
    out = [("renamed", new, old, a[old]["type"], b[new]["type"]) for old, new in pairs]
    for old, new in [(k, k) for k in a if k in b] + pairs:
        if a[old]["type"] and b[new]["type"] and not a[old]["type"] == merged(a[old]["type"], b[new]["type"]) == b[new]["type"]:
            out.append(("retyped", new, old, a[old]["type"], b[new]["type"]))
    old, new = {o for o, _ in pairs}, {n for _, n in pairs}
    out += [("added", k, None, None, p["type"]) for k, p in b.items() if k not in a and k not in new]
    out += [("removed", k, k, p["type"], None) for k, p in a.items() if k not in b and k not in old]
    return [(*x, merged(x[3], x[4])) for x in sorted(out, key=lambda x: (x[1], x[0]))]


CHANGES = "feed string, file_no int, previous_file_no int, change string, field string, previous_field string, previous_type string, type string, promoted_type string"


def changes(profile: DataFrame) -> DataFrame:
    """All changes of each file against the file with the preceding file_no of its
    feed (columns of CHANGES).  A feed's first file has none.

    The window over a feed sees file numbers only; profiles meet by an equi-join
    on feed and file number, so a feed with a third of all files is spread out.
    """
    profile = materialize(packed(profile), "packed")
    numbers = profile.select("feed", "file_no")
    follows = numbers.withColumn("previous", F.lag("file_no").over(W.partitionBy("feed").orderBy("file_no"))).filter("previous is not null")
    before = profile.select("feed", F.col("file_no").alias("previous"), F.col("fields").alias("then"))
    pairs = follows.join(profile, ["feed", "file_no"]).join(before, ["feed", "previous"]).select("feed", "file_no", "previous", "then", F.col("fields").alias("now"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for feed, file_no, previous, then, now in batch.itertuples(index=False):
                rows += [(feed, file_no, previous, *change) for change in _differences(list(then), list(now))]
            yield pd.DataFrame(rows, columns=_CHANGE_NAMES)

    return pairs.mapInPandas(compare, CHANGES)


_CHANGE_NAMES = [c.split()[0] for c in CHANGES.split(", ")]


def union_schema(profile: DataFrame) -> DataFrame:
    """(field, type, spark_type, files, feeds): each field's type promoted over all files."""
    present = [F.max(F.when(F.col("type") == t, True)).alias(t) for t in TYPES]
    every = typed(profile).groupBy("field").agg(*present, F.count("*").alias("files"), F.count_distinct("feed").alias("feeds"))
    seen = F.array_compact(F.array(*[F.when(F.col(t), F.lit(t)) for t in TYPES]))
    merged = F.reduce(seen, F.lit(None).cast("string"), lambda acc, t: F.when(acc.isNull(), t).otherwise(_promoted(acc, t)))
    table = F.create_map(*[F.lit(x) for pair in SPARK_TYPES.items() for x in pair])
    out = every.select("field", F.coalesce(merged, F.lit("string")).alias("type"), "files", "feeds")
    return out.withColumn("spark_type", table[F.col("type")])


def _promoted(a, b):
    table = F.create_map(*[F.lit(x) for p in TYPES for q in TYPES for x in (f"{p}|{q}", promote(p, q))])
    return table[F.concat(a, F.lit("|"), b)]


def canonical_names(profile: DataFrame, wanted: dict[str, str] = CANONICAL) -> DataFrame:
    """(feed, file_no, field, type, canonical): which field of each file holds which wanted column.

    The files that spell a wanted name give its reference profile; in a file
    without it, the field with the most alike content is taken, if alike enough.
    """
    names = list(wanted)
    sums = [F.sum(m).alias(m) for m in (*MEASURES, *CELLS)]
    spelled = profile.filter(F.col("field").isin(names)).groupBy("field").agg(*sums).select("field", *MEASURES, _sketch())
    model = {r["field"]: r.asDict() for r in spelled.collect()}  # as many rows as wanted columns

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for feed, file_no, now in batch.itertuples(index=False):
                own = {p["field"]: p for p in now}
                missing = [model[n] for n in names if n not in own and n in model]
                rest = [p for k, p in own.items() if k not in names]
                pairs = [(n, n) for n in names if n in own] + [(field, name) for name, field in renames(missing, rest)]
                rows += [(feed, file_no, field, own[field]["type"], name) for field, name in pairs]
            yield pd.DataFrame(rows, columns=["feed", "file_no", "field", "type", "canonical"])

    return packed(profile).mapInPandas(assign, "feed string, file_no int, field string, type string, canonical string")


def once(lines: DataFrame) -> DataFrame:
    """(feed, file_no, line_no, line), equal lines of a file and place once.

    Only files that were delivered more than once are shuffled.
    """
    rows = lines.select("feed", F.col("file_no").cast("int").alias("file_no"), "line_no", "line").filter("feed is not null and file_no is not null")
    again = rows.groupBy("feed", "file_no", "line_no", F.md5("line").alias("_h")).count().filter("count > 1").select("feed", "file_no").distinct()
    again = broadcast_if_small(materialize(again, "again"))
    return rows.join(again, ["feed", "file_no"], "left_anti").union(rows.join(again, ["feed", "file_no"], "left_semi").dropDuplicates(["feed", "file_no", "line_no", "line"]))


def unified(lines: DataFrame, names: DataFrame, wanted: dict[str, str] = CANONICAL) -> DataFrame:
    """(feed, file_no, line_no, *wanted): one row per distinct valid line of a file.

    The fields that hold a wanted column in the various files have a union type
    under the lattice; values are cast to it and then to the wanted type.  Values that can't
    be cast, or not without loss (fractions and numbers out of range for a whole number), are null, and so
    are all columns in a file without any wanted field; a list or object stands
    for its scalars, joined by spaces.  A file that arrived twice gives each line
    once.
    """
    keep = list(wanted)
    names = materialize(names, "names")
    types = names.filter("type is not null").groupBy("canonical").agg(F.collect_set("type").alias("t"))
    union = {r["canonical"]: reduce(promote, r["t"]) for r in types.collect()}  # as many rows as wanted columns
    mapping = names.groupBy("feed", "file_no").agg(F.map_from_entries(F.collect_list(F.struct("canonical", "field"))).alias("names"))
    joined = spread_join(once(lines), mapping, ["feed", "file_no"], by=["line_no"], how="left")  # files without any wanted field have no names

    def open_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for feed, file_no, line_no, line, fields_of in batch[["feed", "file_no", "line_no", "line", "names"]].itertuples(index=False):
                record = parse(line)
                if record is not None:
                    own = fields(record)
                    of = dict(fields_of) if fields_of is not None else {}
                    values = [own.get(of.get(n)) if n in of else None for n in keep]
                    rows.append((feed, file_no, line_no, *map(content, values)))
            yield pd.DataFrame(rows, columns=["feed", "file_no", "line_no", *keep], dtype=object)

    kind_of = lines.schema["line_no"].dataType.simpleString()
    text = joined.mapInPandas(open_up, f"feed string, file_no int, line_no {kind_of}, " + ", ".join(f"`{n}` string" for n in keep))
    return text.select("feed", "file_no", "line_no", *[cast_through(F.col(f"`{n}`"), union.get(n, "string"), t).alias(n) for n, t in wanted.items()])


def cast_through(text: Column, union: str, wanted: str) -> Column:
    """A value's text, read as the union type of its field and then as the wanted Spark type; null where that loses anything."""
    if wanted == "string" or union == "boolean" or SPARK_TYPES[union] == wanted:
        return text.try_cast(wanted)
    if wanted == "bigint":  # a decimal holds whole numbers that a double would round
        number = text.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    return text.try_cast(wanted)
