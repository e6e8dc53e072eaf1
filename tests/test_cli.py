import json

import pytest

from siltstone.cli import main as cli


def test_commands(spark, tmp_path, capsys):
    src = tmp_path / "in" / "s2orc"
    src.mkdir(parents=True)
    (src / "a.jsonl").write_text("\n".join(json.dumps({"text": f"why does it rain {i}", "subset": "x", "meta": {"url": "u", "openaccessinfo": {"license": 1}}}) for i in range(9)) + "\n")
    assert cli.main(["annotate", str(tmp_path / "in"), str(tmp_path / "annotated")]) == 0
    assert cli.main(["classify", str(tmp_path / "annotated"), str(tmp_path / "classified")]) == 0
    assert cli.main(["count", str(tmp_path / "classified"), "--json", str(tmp_path / "n.json")]) == 0
    assert json.loads((tmp_path / "n.json").read_text())["TOTAL"] == 9 and "TOTAL\t9" in capsys.readouterr().out
    assert cli.main(["shuffle", str(tmp_path / "classified"), str(tmp_path / "shards"), "--piles", "3", "--lines", "2"]) == 0
    rows = [json.loads(x) for p in (tmp_path / "shards").glob("part*") for x in p.read_text().splitlines()]
    assert len(rows) == 9 and all(r["subset"] == "x" and "meta.lang" in r for r in rows)
    assert cli.main(["classify", str(tmp_path / "in"), str(tmp_path / "in" / "out")]) == 1
    part = next(p for p in (tmp_path / "classified").rglob("*.parquet"))
    assert cli.main(["salvage", str(part)]) == 0 and "full" in capsys.readouterr().out
    assert cli.main(["salvage", str(tmp_path / "none")]) == 2


def test_inspect(spark, tmp_path, capsys):
    p = tmp_path / "a.jsonl"
    p.write_text(json.dumps({"m": [{"t": "x" * 5000}, {"t": "y"}] + [{"t": str(i)} for i in range(8)]}) + "\n\n")
    assert cli.main(["inspect", "-i", "0", str(p), "m.[1].t"]) == 0
    assert capsys.readouterr().out == f"m.[1].t\ny\nfilename\n{p}\nline_number\n0\n"
    assert cli.main(["inspect", str(p)]) == 0
    out = capsys.readouterr().out
    assert "[truncated: 1 lines, 5000 chars" in out and "m.[7].t" not in out and "m.[...]\n… [truncated array: 10 items; showing first 6, omitted 4]" in out
    for bad in (["-i", "1", str(p)], ["-i", "5", str(p)], ["-i", "0", str(p), "m.x"], [str(tmp_path / "none")]):
        assert cli.main(["inspect", *bad]) == 1


@pytest.mark.parametrize("index, code", [(0, 0), (2, 1)])
def test_inspect_json(spark, tmp_path, index, code):
    (tmp_path / "a.json").write_text('[{"a": 1}, 2]')
    assert cli.main(["inspect", "-i", str(index), str(tmp_path / "a.json")]) == code


def test_annotate_again_skips_what_is_done_and_reports_failures(spark, tmp_path, capsys):
    src, out = tmp_path / "in", str(tmp_path / "out")
    (src / "x").mkdir(parents=True)
    (src / "x" / "a b.jsonl").write_text('{"text": "one"}\n{"text": "two"}\n')
    (src / "bad.jsonl").write_text('{"text": "three"}\nbroken\n')
    (src / "empty.jsonl").write_text("")
    assert cli.main(["annotate", str(src), out]) == 1
    assert "bad.jsonl" in capsys.readouterr().err
    read = lambda: sorted((r["source_file"], r["text"]) for r in spark.read.parquet(out).collect())
    first = [("x/a b.jsonl", "one"), ("x/a b.jsonl", "two")]
    assert read() == first
    stamp = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("part*") if "_status" not in str(p)}
    (src / "bad.jsonl").write_text('{"text": "three"}\n')
    assert cli.main(["annotate", str(src), out]) == 0
    assert read() == [("bad.jsonl", "three"), *first]
    assert all(p.stat().st_mtime_ns == t for p, t in stamp.items())
    assert cli.main(["annotate", str(src), str(src / "x")]) == 1


def test_shuffle_checks_schemas_and_parts(spark, tmp_path, capsys):
    source = tmp_path / "in"
    spark.range(50).repartition(2).write.parquet(str(source))
    assert cli.main(["shuffle", str(source), str(tmp_path / "s"), "--piles", "4", "--lines", "5"]) == 0
    manifest = json.loads((tmp_path / "s" / "_manifest.json").read_text())
    assert manifest == {"rank": 0, "world_size": 1, "num_piles": 4, "empty": False}
    assert cli.main(["shuffle", str(source), str(tmp_path / "s"), "--piles", "4"]) == 1
    spark.range(0).write.parquet(str(tmp_path / "none"))
    assert cli.main(["shuffle", str(tmp_path / "none"), str(tmp_path / "e"), "--piles", "4"]) == 0
    assert json.loads((tmp_path / "e" / "_manifest.json").read_text())["empty"]
    spark.sql("SELECT 'x' AS other").write.mode("append").parquet(str(source))
    assert cli.main(["shuffle", str(source), str(tmp_path / "t")]) == 1
    assert "differ in schema" in capsys.readouterr().err
    (tmp_path / "nothing").mkdir()
    assert cli.main(["shuffle", str(tmp_path / "nothing"), str(tmp_path / "u")]) == 1


def test_wrong_parts(spark):
    from siltstone.operators import shuffling

    sizes = spark.createDataFrame([(0, 10), (1, 1), (2, 4)], "pile int, n bigint")
    parts = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (3, 0)], "pile int, part int")
    assert sorted(map(tuple, shuffling.wrong_parts(sizes, parts, 5).collect())) == [(2, 1, 0), (3, 0, 1)]


def test_interactive_and_verbose(spark, tmp_path, capsys, monkeypatch):
    import io

    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"n": i}) + "\n" for i in range(50)))
    monkeypatch.setattr("sys.stdin", io.StringIO("\n\nq\n"))
    assert cli.main(["inspect", "-I", "-v", str(tmp_path), "n"]) == 0
    got = capsys.readouterr()
    assert got.out.count("line_number") == 3 and len({line for line in got.out.splitlines() if line.isdigit()}) > 1
    assert '"from_folder": true' in got.err
    for bad in (["-I", "-i", "0"], ["-i", "0"], ["-i", "-1"]):
        assert cli.main(["inspect", *bad, str(tmp_path)]) == 1


def test_inspect_token_file(spark, tmp_path, capsys):
    from siltstone.sources import token_files

    token_files.write(str(tmp_path / "a.ds"), [5, 0, 6, 0], 2, "tok")
    (tmp_path / "tok.json").write_text('{"model": {"vocab": {"<|endoftext|>": 0}}}')
    assert cli.main(["inspect", str(tmp_path / "a.ds"), "--tokenizers", str(tmp_path)]) == 0
    assert [json.loads(x)["tokens"] for x in capsys.readouterr().out.splitlines()] == [[5, 0], [6, 0]]
    assert cli.main(["inspect", str(tmp_path / "a.ds")]) == 1


def test_empty_categories_have_folders(spark, tmp_path):
    from siltstone.operators import quality

    rows = spark.createDataFrame([("t", 0.0)], "text string, fasttext_eli5_score double")
    quality.write_categories(quality.classify(quality.project(rows)), str(tmp_path / "c"))
    assert {p.name for p in (tmp_path / "c").iterdir() if p.is_dir()} == {f"category={c}" for c in quality.CATEGORIES}


def test_an_empty_first_pile_is_no_wrong_part(spark, tmp_path):
    from siltstone.operators import shuffling

    rows = shuffling.with_pile(spark.range(60), "id", 3).filter("pile != 0").select("id")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    assert cli.main(["shuffle", str(tmp_path / "in"), str(tmp_path / "out"), "--piles", "3", "--lines", "7", "--key", "id"]) == 0
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "out").glob("part*")) == rows.count()
