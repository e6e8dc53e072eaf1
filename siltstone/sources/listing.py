"""Listing of input files by URI, in component-wise path order."""

from __future__ import annotations

import hashlib
from pathlib import PurePosixPath

from pyarrow import fs

from . import storage

SUPPORTED = (".json", ".traj", ".jsonl", ".jsonl.gz", ".parquet", ".ds")
UNFINISHED = "_tmp.jsonl.gz"


def _by_parts(path: str) -> tuple[str, ...]:
    return PurePosixPath(path).parts


def files(root: str, suffixes: tuple[str, ...], hidden: bool = True, any_case: bool = False) -> list[str]:
    """Relative paths of the files below root with one of the suffixes.

    hidden=False leaves out names that begin with ``.`` or ``_`` (of files, not of
    folders); any_case ignores case in the suffix.
    """
    found = []
    for path in storage.below(root):
        name = path.rpartition("/")[2]
        if (name.lower() if any_case else name).endswith(suffixes) and (hidden or name[0] not in "._"):
            found.append(path)
    return sorted(found, key=_by_parts)


def shard(paths: list[str], rank: int, world: int) -> list[str]:
    """Every world-th path from rank on."""
    if world <= 0 or not 0 <= rank < world:
        raise ValueError(f"invalid rank {rank} of {world}")
    return sorted(paths, key=_by_parts)[rank::world]


def inspectable(root: str) -> list[str]:
    """Files that can be inspected, unfinished ones left out; ValueError if there are none."""
    kind = storage.kind(root)
    if kind == fs.FileType.Directory:
        found = [f"{root}/{p}" for p in files(root, SUPPORTED) if not p.endswith(UNFINISHED)]
        if not found:
            raise ValueError("the folder has no suitable files")
        return found
    if kind != fs.FileType.File:
        raise ValueError("the path is neither a file nor a folder")
    if root.endswith(UNFINISHED):
        raise ValueError("the file is an unfinished one")
    if not root.endswith(SUPPORTED):
        raise ValueError("unsupported file extension")
    return [root]


def pick(root: str, seed: int = 0) -> str:
    """One of the inspectable files, uniform over seeds and independent of their order."""
    return min(inspectable(root), key=lambda p: hashlib.md5(f"{seed}:{p}".encode()).hexdigest())


def output_of(path: str, root: str, target: str, suffix: str = ".parquet") -> str:
    """Where a file's result goes: the same relative folder, the last extension replaced."""
    relative = PurePosixPath(path).relative_to(root)
    return str(PurePosixPath(target) / relative.parent / (relative.stem + suffix))


def outputs(paths: list[str], root: str, target: str) -> dict[str, str]:
    """Result path of each file; ValueError if two files share one."""
    out = {p: output_of(p, root, target) for p in paths}
    if len(set(out.values())) != len(out):
        raise ValueError("two inputs have the same output")
    return out
