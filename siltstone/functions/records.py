"""Expressions on single records, all of them JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits of shortened output.
MAX_LINES, MAX_CHARS, MAX_ITEMS = 12, 4000, 6
# The line breaks of Python's str.splitlines.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def flatten(df: DataFrame) -> DataFrame:
    """One level of structs opened to ``parent.child`` columns.

    Deeper structs stay nested, a struct without fields vanishes, and of two
    columns of one name the later one wins, in the earlier one's place.
    """
    cells: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for child in f.dataType.names:
                cells[f"{f.name}.{child}"] = F.col(f"`{f.name}`").getField(child)
        else:
            cells[f.name] = F.col(f"`{f.name}`")
    return df.select(*[c.alias(n) for n, c in cells.items()])


def prompt(text: Column, url: Column | None = None) -> Column:
    """``{url}``, an empty line and the text for url-aware scorers; a null url is empty, a null text null."""
    return text if url is None else F.concat(F.coalesce(url, F.lit("")), F.lit("\n\n"), text)


def first_message(messages: Column) -> Column:
    """Content of the first message; a null or empty list is an error under ANSI mode, as an absent text is."""
    return F.element_at(messages, 1)["content"]


def one_line(text: Column) -> Column:
    """Line feeds and carriage returns as spaces, as linear text models take their input."""
    return F.translate(text, "\n\r", "  ")


def argmax(values: Column) -> Column:
    """Zero-based place of the first maximum; null for null and empty arrays."""
    return F.when(F.size(values) > 0, F.array_position(values, F.array_max(values)) - 1)


def lines(text: Column) -> Column:
    """Lines as Python's splitlines gives them: a trailing break adds no empty line."""
    parts = F.split(text, LINE_BREAK)
    trimmed = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(trimmed)


def truncate_text(text: Column, max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS) -> Column:
    """Text of more lines or characters shortened to both limits, with a note of its size."""
    parts = lines(text)
    head = F.substring(F.array_join(F.slice(parts, 1, max_lines), "\n"), 1, max_chars)
    note = F.concat(
        F.lit("\n\n… [truncated: "), F.size(parts).cast("string"), F.lit(" lines, "), F.length(text).cast("string"),
        F.lit(f" chars; showing up to {max_lines} lines / {max_chars} chars]"),
    )
    fits = (F.length(text) <= max_chars) & (F.size(parts) <= max_lines)
    return F.when(text.isNull() | fits, text).otherwise(F.concat(head, note))


def truncate_list(values: Column, max_items: int = MAX_ITEMS) -> tuple[Column, Column]:
    """(head, note) of a list: its first items, and what was left out or null."""
    size = F.size(values)
    note = F.concat(
        F.lit("… [truncated array: "), size.cast("string"), F.lit(f" items; showing first {max_items}, omitted "),
        (size - max_items).cast("string"), F.lit("]"),
    )
    return F.slice(values, 1, max_items), F.when(size > max_items, note)


def decorate(df: DataFrame, filename: str | Column, line_number: Column | None = None) -> DataFrame:
    """df with ``filename`` and ``line_number`` as last columns, in place of columns so named."""
    added = {"filename": F.lit(filename) if isinstance(filename, str) else filename}
    if line_number is not None:
        added["line_number"] = line_number
    rest = [F.col(f"`{c}`") for c in df.columns if c not in added]
    return df.select(*rest, *[c.alias(n) for n, c in added.items()])


def json_line(df: DataFrame, columns: Sequence[str] | None = None, decimals: bool = False) -> Column:
    """Each row as one JSON object with all columns, nulls written.

    NaN and infinities are written as null, floats with the digits of their
    double value.  Binary (and decimal, unless decimals is set) columns are an
    error: JSON can't carry them unchanged.
    """
    cells = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        reject_unwritable(kind, name, decimals)
        cells.append(_finite(F.col(f"`{name}`"), kind).alias(name))
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def reject_unwritable(kind: T.DataType, name: str, decimals: bool = False) -> None:
    if isinstance(kind, T.BinaryType) or (isinstance(kind, T.DecimalType) and not decimals):
        raise ValueError(f"column {name} of type {kind.simpleString()} must be converted before it is written as JSON")
    for part in [getattr(kind, "elementType", None), getattr(kind, "valueType", None), *[f.dataType for f in getattr(kind, "fields", [])]]:
        if part is not None:
            reject_unwritable(part, name, decimals)


def _finite(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        wide = value.cast("double")
        return F.when(~F.isnan(wide) & (F.abs(wide) != float("inf")), wide)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _finite(v, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_finite(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return value
