import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import adapters, resume, scoring, shuffling
from siltstone.plans import runtime
from siltstone.streaming import incremental


def order(df, partitions, seed=1):
    rows = shuffling.permuted(df.repartition(partitions), "id", 5, seed).collect()
    return sorted((r["pile"], r["pos"], r["id"]) for r in rows)


def test_order_ignores_partitions(spark):
    df = spark.range(200)
    first = order(df, 1)
    assert first == order(df, 3) == order(df, 7)
    assert first != order(df, 3, seed=2)
    assert sorted(i for *_, i in first) == list(range(200))


def test_shards(spark, tmp_path):
    df = spark.range(300).select("id", F.lit(None).cast("string").alias("note"))
    shuffling.write_shards(df, str(tmp_path / "s"), "id", 4, 20, seed=3)
    parts = [p for p in (tmp_path / "s").iterdir() if p.name.startswith("part")]
    rows = [[json.loads(x) for x in p.read_text().splitlines()] for p in parts]
    assert max(map(len, rows)) <= 20
    assert sorted(r["id"] for part in rows for r in part) == list(range(300)) and all("note" in r for part in rows for r in part)
    piles = {r["id"]: r["pile"] for r in shuffling.with_pile(df, "id", 4, 3).collect()}
    assert all(len({piles[r["id"]] for r in part}) == 1 for part in rows)
    with pytest.raises(ValueError):
        shuffling.write_shards(df, str(tmp_path / "t"), "id", 4, 0)
    with pytest.raises(ValueError):
        shuffling.with_pile(df, "id", 0)


def test_assigned_piles():
    for strategy in ("modulo", "contiguous"):
        got = [p for r in range(3) for p in shuffling.assigned_piles(10, r, 3, strategy)]
        assert sorted(got) == list(range(10))
    assert shuffling.assigned_piles(0, 0, 3) == []
    with pytest.raises(ValueError):
        shuffling.assigned_piles(3, 0, 1, "other")


def test_manifests(spark):
    rows = [(1, 0, 2, 8), (1, 1, 2, 8), (1, 1, 2, 8), (2, 0, 3, 8), (2, 2, 3, 8), (3, 0, 2, 8), (3, 1, 2, 16), (4, None, 1, 8), (5, 0, 2, 8), (5, 2, 2, 8)]
    df = spark.createDataFrame(rows, "run_id bigint, rank int, world_size int, num_piles int")
    assert {r["run_id"]: r["ok"] for r in shuffling.check_manifests(df).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert shuffling.check_manifests(df.limit(0)).count() == 0


def test_adapters(spark):
    odd = [True, 3, 2.5, float("inf"), "x", " 11 ", None, [1, None, "a"], {"b": 1, "a": None}]
    assert [adapters.parsed_int(v) for v in odd] == [1, 3, None, None, None, 11, None, None, None]
    assert [adapters.as_int(v) for v in odd] == [1, 3, None, None, None, None, None, None, None]
    assert [adapters.any_str(v) for v in odd[4:]] == ["x", " 11 ", None, "1 |  | a", '{"a": null, "b": 1}']
    assert adapters.nested_ints(3)([[[1, 2.5, None], None], None]) == [[[1, None, None], None], None]
    assert adapters.nested_ints(3)([[1]]) is None
    line = json.dumps({"text": "t", "meta": {"hplt_attr": {"c": 1, "o": 5, "doc_scores": [1, "x", None], "pii": [[[1]]], "seg_langs": ["en", 2]}, "other": 1}})
    df = spark.createDataFrame([("f", line), ("g", '{"text": "u"}')], "file string, line string")
    rows = {r["file"]: r for r in adapters.apply(df, adapters.HPLT).collect()}
    attr = rows["f"]["meta.hplt_attr"]
    assert (attr["c"], attr["o"], attr["doc_scores"], attr["pii"], attr["seg_langs"]) == (None, 5, [1.0, None, None], [[[1]]], ["en", None])
    assert rows["g"]["meta.hplt_attr"] is None and rows["g"]["text"] == "u"
    uspto = adapters.apply(spark.createDataFrame([(json.dumps({"text": ["a", None], "meta": {"token_count": "7", "z": {"b": 1}}}),)], "line string"), adapters.USPTO, more=("meta.z",)).first()
    assert (uspto["text"], uspto["meta.token_count"], uspto["meta.z"]) == ("a | ", 7, '{"b": 1}')
    with pytest.raises(Exception, match="no JSON object"):
        adapters.apply(spark.createDataFrame([("[1]",)], "line string"), adapters.S2ORC).collect()
    assert adapters.choose("/x/MegaMath/a").name == "megamath" and adapters.choose("/x") is None


def test_scoring(spark):
    df = spark.createDataFrame([("why because knowledge " * 5, "u", 1.0), (None, None, 2.0), ("", None, 3.0)], "text string, url string, TopicClassifier double")
    out = scoring.score(df, scoring.lexical(), "text", "url", [*scoring.lexical().outputs, "absent"])
    rows = out.collect()
    assert rows[1]["jais_token_count"] is None and rows[2]["jais_token_count"] == 1 and rows[0]["absent"] is None
    assert dict(out.dtypes)["TopicClassifier"] == "bigint" and rows[0]["fasttext_eli5_score"] > 0


def test_resume(spark, tmp_path):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert {r["k"] for r in resume.pending(a, spark.createDataFrame([(2,)], "k int"), "k").collect()} == {1, None}
    assert resume.blocks(list("abcde"), 4) == [["a", "b"], ["c", "d"], ["e"], []]

    def work(item, target):
        if item == "bad":
            raise OSError("no")
        open(target, "w").close()

    task = resume.ItemTask(["a", "bad", "c"], str(tmp_path / "o"), work)
    with pytest.raises(RuntimeError, match="bad"):
        task.run()
    assert task.is_done("a") and task.is_done("c") and not task.is_done("bad")


def test_stream_takes_files_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("1\n2\n")
    run = lambda: incremental.process_new(incremental.new_lines(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    (src / "b.jsonl").write_text("3\n")
    run()
    run()
    assert sorted(r["line"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


def test_runtime(tmp_path):
    assert runtime.rank_and_world({}) == (0, 1)
    assert runtime.rank_and_world({"RANK": "2", "WORLD_SIZE": "3"}) == (2, 3)
    slurm = {"SLURM_ARRAY_TASK_ID": "6", "SLURM_ARRAY_TASK_COUNT": "3", "SLURM_ARRAY_TASK_MIN": "2", "SLURM_ARRAY_TASK_STEP": "2", "SLURM_ARRAY_TASK_MAX": "6"}
    assert runtime.rank_and_world(slurm) == (2, 3)
    for bad in ({"RANK": "1"}, {"RANK": "3", "WORLD_SIZE": "3"}, slurm | {"SLURM_ARRAY_TASK_MAX": "8"}, slurm | {"SLURM_ARRAY_TASK_ID": "5"}):
        with pytest.raises(ValueError):
            runtime.rank_and_world(bad)
    runtime.separate("/a/b", "/a/c")
    for bad in ("/a/b", "/a/b/c"):
        with pytest.raises(ValueError):
            runtime.separate("/a/b", bad)
    with pytest.raises(ValueError):
        runtime.positive(lines=0)


def test_scope_and_sweep_remove_tables(spark, tmp_path, monkeypatch):
    import os

    from siltstone.plans import lineage

    monkeypatch.setattr(lineage, "shared_folder", lambda spark: f"file://{tmp_path}")
    with lineage.scope():
        df = lineage.materialize(spark.range(3), "gone")
        path = df.inputFiles()[0]
        assert df.count() == 3
    from siltstone.sources import storage

    assert not storage.exists(path)
    kept = lineage.materialize(spark.range(3), "kept")
    left = tmp_path / "siltstone" / "left-1"
    left.mkdir()
    os.utime(left, (1, 1))
    assert lineage.sweep(spark, hours=1) == 1 and not left.exists() and kept.count() == 3


def test_cast_to(spark):
    from siltstone.sources import parquet

    out = parquet.cast_to(spark.sql("SELECT 1 AS b, 'x' AS extra"), spark.sql("SELECT 'a' AS a, 2.0D AS b"))
    assert out.columns == ["a", "b"] and tuple(out.first()) == (None, 1.0)
