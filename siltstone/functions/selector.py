"""Selecting and walking parts of nested JSON records.

A selector names a path: keys joined by dots, ``[n]`` for a list's item, ``[]`` or
``[*]`` for all of its items, ``["a.b"]`` for a key with special signs.  It is
compiled once on the driver to steps over VARIANT values, so records of any
shape are searched without a schema.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = object()  # every item of a list


# One step: a dot (which only separates), a bracket with a quoted key, nothing or a star, a number or a bare key, or a plain key.
_STEP = re.compile(
    r"""(?P<dot>\.)
      | \[ (?: "(?P<double>[^"]*)" | '(?P<single>[^']*)' | \s* (?: (?P<all>\*?) | (?P<negative>-\d+) | (?P<index>\d+) | (?P<bare>[^\]"'\s][^\]]*?) ) \s* ) \]
      | (?P<key>[^.\[]+)""",
    re.VERBOSE,
)
_MEANING = {"double": str, "single": str, "bare": str, "key": str, "index": int, "all": lambda _: ALL}


def parse(selector: str) -> list:
    """Steps of a selector: str for keys, int for items, ALL.  ValueError if malformed."""
    text = selector.strip()
    if not text:
        raise ValueError("empty selector")
    steps, at = [], 0
    while at < len(text):
        found = _STEP.match(text, at)
        if found is None or found.lastgroup == "negative":
            raise ValueError(f"no step (an open bracket or quote, or a negative index) at character {at} of the selector {text}")
        if found.lastgroup != "dot":
            steps.append(_MEANING[found.lastgroup](found[found.lastgroup]))
        at = found.end()
    return steps


def select(df: DataFrame, column: str, selector: str) -> DataFrame:
    """All matches of a selector in a column of JSON text: the other columns of df
    with ``path`` (as ``a.[0].b``) and ``value`` (JSON text; a JSON null is a match).

    Wildcards and indices apply to lists only, keys to objects only; what has no
    such part gives no row, as do null and invalid JSON.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (column, "path", "value")]
    rows = df.select(*keep, F.lit("").alias("path"), F.try_parse_json(F.col(f"`{column}`")).alias("_v"))
    names = [c for c in df.columns if c not in (column, "path", "value")]
    for step in parse(selector):
        if step is ALL:
            # variant_explode also opens objects; those have a key.
            rows = rows.sparkSession.sql(
                "SELECT r.*, e.pos AS _pos, e.value AS _item FROM {rows} r, LATERAL variant_explode(r._v) AS e WHERE e.key IS NULL", rows=rows
            )
            piece, item = F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")), F.col("_item")
        else:
            piece = F.lit(f"[{step}]" if isinstance(step, int) else step)
            item = F.try_variant_get("_v", _path(step), "variant")
        path = F.when(F.col("path") == "", piece).otherwise(F.concat("path", F.lit("."), piece))
        rows = rows.select(*[F.col(f"`{c}`") for c in names], path.alias("path"), item.alias("_v")).filter("_v is not null")
    return rows.select(*[F.col(f"`{c}`") for c in names], "path", F.to_json("_v").alias("value"))


def _path(step: str | int) -> str:
    if isinstance(step, int):
        return f"$[{step}]"
    if '"' in step and "'" in step:
        raise ValueError("a key can't hold both kinds of quotes")
    return f"$['{step}']" if '"' in step else f'$["{step}"]'


def leaves(value, path: tuple[str, ...] = ()) -> Iterator[tuple[str, object]]:
    """(dotted path, scalar) depth first in the order of keys; empty containers give nothing."""
    stack = [(path, value)]
    while stack:
        at, v = stack.pop()
        if isinstance(v, dict):
            stack.extend(reversed([((*at, str(k)), x) for k, x in v.items()]))
        elif isinstance(v, list):
            stack.extend(reversed([((*at, f"[{i}]"), x) for i, x in enumerate(v)]))
        else:
            yield ".".join(at), v


def walk(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, ordinal, path, value) of all scalars of each row's JSON text, in order.

    value is JSON text, so null, 1 and 1.0 stay apart; invalid or null JSON gives
    no row.  Runs in Python since VARIANT would sort keys and drop ``.0``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch["key"], batch["json"]):
                try:
                    value = json.loads(text) if text is not None else None
                except (ValueError, RecursionError):
                    continue
                if text is not None:
                    rows += [(k, i, p, json.dumps(v, ensure_ascii=False)) for i, (p, v) in enumerate(leaves(value))]
            yield pd.DataFrame(rows, columns=[key, "ordinal", "path", "value"])

    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{column}`").alias("json"))
    return source.mapInPandas(run, f"`{key}` {kind}, ordinal int, path string, value string")
