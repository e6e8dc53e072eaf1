"""Driver-side helpers: the place of a process among others, parameters, models and timing."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache
from time import perf_counter

from pyspark.sql import SparkSession

from ..sources.storage import read_text, separate

__all__ = ["LAUNCHERS", "Meter", "models", "positive", "rank_and_world", "separate"]


def _array_ids(env: Mapping[str, str], world: int) -> range:
    part = lambda name, default: int(env.get(f"SLURM_ARRAY_TASK_{name}", default))
    step = part("STEP", 1)
    if step < 1:
        return range(0)
    low = part("MIN", 0)
    return range(low, part("MAX", low + step * (world - 1)) + 1, step)


# Variable of a process's id, that of their number, and the ids that there are.
LAUNCHERS = [
    ("RANK", "WORLD_SIZE", lambda env, world: range(world)),
    ("SLURM_ARRAY_TASK_ID", "SLURM_ARRAY_TASK_COUNT", _array_ids),
]


def rank_and_world(env: Mapping[str, str] = os.environ) -> tuple[int, int]:
    """(rank, world) of a process that shares work by rank, from the first of LAUNCHERS that is set; (0, 1) without one.

    The rank is the id's place among the ids.  ValueError if a variable is
    missing, the ids are not `world` many (a sparse array) or don't have this one.
    """
    for own, size, ids_of in LAUNCHERS:
        if own in env or size in env:
            if not (own in env and size in env):
                raise ValueError(f"{own} and {size} belong together")
            world = int(env[size])
            ids = ids_of(env, world)
            if len(ids) != world or (size != "WORLD_SIZE" and ids[-1] != int(env.get("SLURM_ARRAY_TASK_MAX", ids[-1]))):
                raise ValueError("the ids have gaps; set RANK and WORLD_SIZE")
            return ids.index(int(env[own])), world
    return 0, 1


def positive(**values: int) -> None:
    """ValueError for the first value that is not positive."""
    for name, value in values.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive")


@cache
def models(path: str | None = None) -> dict:
    """Manifest of local models, {column: {"kind", "path", ...}}, from path or MODEL_MANIFEST; empty without one."""
    path = path or os.environ.get("MODEL_MANIFEST")
    if not path:
        return {}
    content = read_text(path)
    if content is None:
        raise ValueError(f"no model manifest at {path}")
    return json.loads(content)


class Meter:
    """Seconds and calls of named steps inside tasks, added up by Spark's accumulators.

    As with all accumulators, a task that runs again counts again.
    """

    def __init__(self, spark: SparkSession, names: list[str]):
        make = spark.sparkContext.accumulator
        self.sums = {n: (make(0.0), make(0)) for n in names}

    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        seconds, calls = self.sums[name]
        began = perf_counter()
        yield
        seconds.add(perf_counter() - began)
        calls.add(1)

    def report(self) -> dict[str, dict[str, float]]:
        return {n: {"seconds": s.value, "calls": c.value} for n, (s, c) in self.sums.items()}
