"""python -m siltstone.cli.main annotate | classify | count | shuffle | salvage | inspect"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from ..functions import selector
from ..functions.records import MAX_ITEMS, truncate_text
from ..operators import quality, scoring
from ..plans import annotate as plans
from ..plans.lineage import scope
from ..plans.runtime import models
from ..session import build
from ..sources import jsonl, listing, parquet, recovery, storage, token_files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone")
    sub = top.add_subparsers(dest="command", required=True)
    a = sub.add_parser("annotate", help="JSON lines to scored Parquet")
    a.add_argument("source"), a.add_argument("target"), a.add_argument("--models", help="manifest of local models; without it stand-ins score")
    c = sub.add_parser("classify", help="scored Parquet to quality categories")
    c.add_argument("source"), c.add_argument("target"), c.add_argument("--breaks-dir"), c.add_argument("--rows-per-file", type=int, default=quality.ROWS_PER_FILE)
    n = sub.add_parser("count", help="rows per folder")
    n.add_argument("source"), n.add_argument("--json")
    s = sub.add_parser("shuffle", help="Parquet to shuffled JSON shards")
    s.add_argument("source"), s.add_argument("target"), s.add_argument("--piles", type=int, default=4096), s.add_argument("--lines", type=int, default=100_000)
    s.add_argument("--seed", type=int, default=0), s.add_argument("--key", default=None)
    r = sub.add_parser("salvage", help="diagnose a Parquet file, or save what can be read to --target")
    r.add_argument("source"), r.add_argument("--target"), r.add_argument("--keep-bad-columns", action="store_true")
    r.add_argument("--like", help="Parquet table whose columns, order and types the saved rows get")
    i = sub.add_parser("inspect", help="print one record or a selection of it")
    i.add_argument("source"), i.add_argument("selector", nargs="?"), i.add_argument("-i", "--index", type=int), i.add_argument("--seed", type=int, default=0)
    i.add_argument("--eos", type=int, help="end id of token files"), i.add_argument("--tokenizers", help="folder of tokenizer files that the end id is looked up in")
    i.add_argument("-I", "--interactive", action="store_true", help="sample again and again until q is entered")
    i.add_argument("-v", "--verbose", action="store_true", help="print what was chosen to the error stream")
    i.add_argument("--full", action="store_true", help="don't shorten texts and lists")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        with scope():  # what was materialized isn't needed once a program has ended
            return globals()[f"run_{args.command}"](args)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


def run_annotate(args) -> int:
    registry = scoring.from_manifest(models(args.models)) if args.models else None
    try:
        plans.annotate_files(build(), args.source, args.target, registry)
    except RuntimeError as e:  # files that failed, the others are done
        raise ValueError(e) from None
    return 0


def run_classify(args) -> int:
    plans.classify_files(build(), args.source, args.target, args.breaks_dir, args.rows_per_file)
    return 0


def run_count(args) -> int:
    rows = {r["category"]: r["n"] for r in parquet.count_by_folder(build(), args.source).collect()}  # one row a folder
    if not rows:
        raise ValueError("no folders with Parquet files")
    for name, n in [*sorted(rows.items()), ("TOTAL", sum(rows.values()))]:
        print(f"{name}\t{n}")
    if args.json:
        with open(args.json, "w", encoding="utf-8") as f:
            json.dump({"per_subdir": rows, "TOTAL": sum(rows.values())}, f, indent=2)
    return 0


def run_shuffle(args) -> int:
    print(json.dumps(plans.shuffle_files(build(), args.source, args.target, args.piles, args.lines, args.seed, args.key)))
    return 0


def run_salvage(args) -> int:
    facts = recovery.check_magic(args.source)
    print(json.dumps(facts))
    if facts["errors"]:
        return 2 if facts["size"] is None else 1
    spark = build()
    found = recovery.salvage_file(spark, args.source, args.target, not args.keep_bad_columns, spark.read.parquet(args.like) if args.like else None) if args.target else recovery.report(spark, [args.source])
    for row in recovery.summary(found).orderBy("status").collect():  # three kinds of status
        print(row.asDict())
    return 0


def run_inspect(args) -> int:
    if args.index is not None and args.interactive:
        raise ValueError("an index and --interactive exclude each other")
    if args.index is not None and args.index < 0:
        raise ValueError("the index must be 0 or more")
    if args.index is not None and listing.inspectable(args.source) != [args.source]:
        raise ValueError("an index needs a file, not a folder")
    spark = build()
    path = listing.pick(args.source, args.seed) if args.index is None else args.source
    if args.verbose:
        print(json.dumps({"arguments": vars(args), "file": path, "from_folder": path != args.source}, indent=2, sort_keys=True), file=sys.stderr)
    if path.endswith(".ds"):
        _print_tokens(spark, path, args)
        return 0
    seed = args.seed
    while True:
        found = _print_record(spark, path, args, seed)
        if not args.interactive:
            if not found:
                raise ValueError("the selector matches nothing")
            return 0
        if not found:
            print("the selector matches nothing in this record")
        print("Enter for another record, q to quit")
        answer = sys.stdin.readline()
        if not answer or answer.strip().lower() == "q":
            return 0
        seed += 1


def _print_tokens(spark, path: str, args) -> None:
    """The first ten documents of a token file."""
    if args.index is not None:
        raise ValueError("token files can't be read by index")
    name = token_files.metadata(path)[0]
    if args.eos is None and not (name and args.tokenizers):
        raise ValueError("a token file needs --eos, or --tokenizers and a tokenizer's name in its metadata")
    eos = args.eos if args.eos is not None else token_files.end_id(name, args.tokenizers)
    for row in token_files.records(spark, path, eos).orderBy("doc_index").collect():
        print(json.dumps(row.asDict()))


def _print_record(spark, path: str, args, seed: int) -> bool:
    """One record, or the parts that the selector names; False if it names none."""
    number, record = _record(spark, path, args.index, seed)
    if args.selector:
        rows = spark.createDataFrame([(json.dumps(record),)], "json string")
        matches = selector.select(rows, "json", args.selector).collect()  # parts of one record
        if not matches:
            return False
        out = {m["path"]: json.loads(m["value"]) for m in matches}
    else:
        out = dict(record) if isinstance(record, dict) else {"data": record}
    out |= {"filename": path} | ({} if number is None else {"line_number": number})
    for where, value in selector.leaves(out if args.full else _shortened(out)):
        if isinstance(value, _Rest):
            where = ".".join([*where.split(".")[:-1], "[...]"])
        elif isinstance(value, str) and not args.full:
            value = spark.range(1).select(truncate_text(F.lit(value)).alias("t")).first()["t"]
        print(f"{where}\n{value}")
    return True


class _Rest:
    """What a shortened list leaves out."""

    def __init__(self, size: int):
        self.size = size

    def __str__(self) -> str:
        return f"… [truncated array: {self.size} items; showing first {MAX_ITEMS}, omitted {self.size - MAX_ITEMS}]"


def _shortened(value):
    if isinstance(value, dict):
        return {k: _shortened(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_shortened(v) for v in value[:MAX_ITEMS]] + ([_Rest(len(value))] if len(value) > MAX_ITEMS else [])
    return value


def _record(spark, path: str, index: int | None, seed: int):
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
        row = parquet.row_at(df, index) if index is not None else parquet.sample_one(parquet.with_row_number(df), "line_number", seed).first()
        value = row.asDict(recursive=True)
        value.pop("file")
        return value.pop("line_number"), json.loads(json.dumps(value, default=str))
    if path.endswith((".jsonl", ".jsonl.gz")):
        lines = jsonl.numbered_files(spark, path)
        if index is not None:
            return index, json.loads(jsonl.line_at(lines, index))
        row = parquet.sample_one(lines.filter("trim(line) != ''"), "line_number", seed).first()
        if row is None:
            raise ValueError("the file is empty")
        return row["line_number"], json.loads(row["line"])
    value = json.loads(storage.read_text(path))
    if index is None:
        return None, value
    if not isinstance(value, list) or not 0 <= index < len(value):
        raise ValueError("the index needs a list that long at the top")
    return index, value[index]


if __name__ == "__main__":
    sys.exit(main())
