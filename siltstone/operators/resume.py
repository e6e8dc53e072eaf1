"""Resuming work whose results are files."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without a result of the same key.  Null keys are never done."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def blocks(items: Sequence[str], parts: int) -> list[list[str]]:
    """Items in `parts` blocks of ceil(n / parts); the last ones may be empty."""
    if parts <= 0:
        raise ValueError("parts must be positive")
    size = -(-len(items) // parts)
    return [list(items[i * size : (i + 1) * size]) for i in range(parts)]


class ItemTask:
    """Per-item work on the driver, skipping items whose output exists.

    Failures are collected, the other items still run, and one error is raised
    at the end.  An output appears only when it is complete.
    """

    def __init__(self, items: Sequence[str], output_dir: str, process: Callable[[str, str], None], suffix: str = ".done"):
        self.items, self.output_dir, self.process, self.suffix = list(items), Path(output_dir), process, suffix
        self.output_dir.mkdir(parents=True, exist_ok=True)

    def output_of(self, item: str) -> str:
        return str(self.output_dir / (os.path.basename(item) + self.suffix))

    def is_done(self, item: str) -> bool:
        return os.path.exists(self.output_of(item))

    def run(self) -> list[str]:
        """Items worked on; RuntimeError that names all failed ones."""
        worked, failed = [], []
        for item in self.items:
            if self.is_done(item):
                continue
            target = self.output_of(item)
            try:
                self.process(item, f"{target}.tmp")
                os.replace(f"{target}.tmp", target)
                worked.append(item)
            except Exception as e:
                failed.append(f"{item}: {e}")
        if failed:
            raise RuntimeError("failed: " + "; ".join(failed))
        return worked


STATUS = "source_file string, rows bigint, failed bigint, first_error string, noted_at timestamp"


def file_status(df: DataFrame, file: str, error: str) -> DataFrame:
    """(file, rows, failed, first_error) of a frame that carries each row's file and error."""
    return df.groupBy(file).agg(F.count("*").alias("rows"), F.count(error).alias("failed"), F.min(error).alias("first_error"))


def raise_if_failed(status: DataFrame, file: str) -> None:
    """RuntimeError that names up to twenty failed files."""
    rows = status.filter("failed > 0").orderBy(file).limit(20).collect()
    if rows:
        raise RuntimeError("failed files: " + ", ".join(f"{r[file]} ({r['first_error']})" for r in rows))
