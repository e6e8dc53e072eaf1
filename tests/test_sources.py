import gzip
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siltstone.sources import jsonl, listing, parquet, recovery, token_files


def test_strict_lines(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_bytes(b'{"a": 1}\r\n{"a": "x\\ry"}\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wb") as f:
        f.write(b'{"a": 2}\n')
    lines = jsonl.read_lines(spark, [str(good), str(tmp_path / "b.jsonl.gz")])
    assert jsonl.strict(lines).count() == 3
    for bad in (b"\n", b"{x\n", b"[1]\n", b'"s"\n'):
        (tmp_path / "bad.jsonl").write_bytes(b'{"a": 1}\n' + bad)
        with pytest.raises(Exception, match="malformed JSON line"):
            jsonl.strict(jsonl.read_lines(spark, str(tmp_path / "bad.jsonl"))).select("record").collect()
        assert jsonl.lenient(jsonl.read_lines(spark, str(tmp_path / "bad.jsonl"))).count() == 1
    got = jsonl.with_schema(jsonl.read_lines(spark, str(tmp_path / "bad.jsonl")), "a bigint", strictly=False).collect()
    assert [r["a"] for r in got] == [1]
    assert "a" in jsonl.infer(lines)


def test_round_trip_and_shard_bound(spark, tmp_path):
    df = spark.sql("SELECT id, if(id % 3 = 0, null, array(named_struct('x', id))) AS a, 'ü\n' AS t FROM range(25)").coalesce(2)
    jsonl.write(df, str(tmp_path / "out"), 4)
    parts = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")]
    assert all(len(p.read_text().splitlines()) <= 4 for p in parts)
    back = jsonl.with_schema(jsonl.read_lines(spark, str(tmp_path / "out")), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_by_index(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 0}\n\n{"a": 2}\n')
    lines = jsonl.read_lines(spark, str(p))
    assert jsonl.line_at(lines, 2) == '{"a": 2}'
    for bad in (1, 3, -1):
        with pytest.raises(ValueError):
            jsonl.line_at(lines, bad)
    (tmp_path / "l.json").write_text('[{"a": 1}, 2]')
    (tmp_path / "o.json").write_text('{"a": 1}')
    assert jsonl.documents(spark, [str(tmp_path / "l.json"), str(tmp_path / "o.json")]).count() == 3


def test_listing(tmp_path):
    for name in ("a/z.jsonl", "a-b/x.jsonl", "a/.h.jsonl", "b/_t.PARQUET", "b/t.PARQUET", "c_tmp.jsonl.gz"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("")
    assert listing.files(str(tmp_path), (".jsonl",)) == ["a/.h.jsonl", "a/z.jsonl", "a-b/x.jsonl"]
    assert listing.files(str(tmp_path), (".parquet",), hidden=False, any_case=True) == ["b/t.PARQUET"]
    assert listing.shard(["a-b/x", "a/z", "c"], 0, 2) == ["a/z", "c"]
    assert listing.pick(str(tmp_path), 1) in listing.inspectable(str(tmp_path))
    with pytest.raises(ValueError):
        listing.inspectable(str(tmp_path / "c_tmp.jsonl.gz"))
    assert listing.output_of("/in/x/a.jsonl.gz", "/in", "/out") == "/out/x/a.jsonl.parquet"
    with pytest.raises(ValueError):
        listing.outputs(["/in/a.jsonl", "/in/a.json"], "/in", "/out")


@pytest.fixture
def damaged(tmp_path):
    path = str(tmp_path / "d.parquet")
    n = 4000
    rnd = np.random.default_rng(0)
    table = pa.table({"k": np.arange(n), "v": rnd.random(n)})
    pq.write_table(table, path, row_group_size=1000, compression="zstd", use_dictionary=False)
    chunk = pq.read_metadata(path).row_group(1).column(1)
    with open(path, "r+b") as f:
        f.seek(chunk.data_page_offset + 8)
        f.write(b"\x00\xff" * 32)
    return path, table


def test_salvage(spark, damaged, tmp_path):
    path, table = damaged
    report = {r["row_group"]: r for r in recovery.report(spark, [path]).collect()}
    assert [report[i]["status"] for i in range(4)] == ["full", "partial", "full", "full"] and report[1]["bad_columns"] == ["v"]
    rows = {r["k"]: r["v"] for r in recovery.salvage(spark, [path]).collect()}
    assert len(rows) == 4000 and all(rows[k] is None for k in range(1000, 2000)) and rows[3999] == table["v"][3999].as_py()
    assert recovery.salvage(spark, [path], drop_bad_columns=False).count() == 3000
    recovery.salvage_file(spark, path, str(tmp_path / "new"))
    with pytest.raises(ValueError):
        recovery.salvage_file(spark, path, str(tmp_path / "new"))
    assert recovery.check_magic(path)["magic_ok"]
    assert recovery.describe(spark, [path]).count() == 8


def test_magic(tmp_path):
    small = tmp_path / "s"
    small.write_bytes(b"PAR1")
    assert recovery.check_magic(str(small))["errors"]
    odd = tmp_path / "o"
    odd.write_bytes(b"PARX" + b"\x00" * 4 + (-5).to_bytes(4, "little", signed=True) + b"PARY")
    assert len(recovery.check_magic(str(odd))["warnings"]) == 4
    assert recovery.check_magic(str(tmp_path / "none"))["errors"]


def test_hetero_files(spark, tmp_path):
    spark.sql("SELECT 'a' AS text, cast(1.5 AS float) AS fasttext_eli5_score, named_struct('lang', 'en') AS meta").write.parquet(str(tmp_path / "1"))
    spark.sql("SELECT 'b' AS text, 2.5D AS fasttext_eli5_score, 'de' AS `meta.lang`").write.parquet(str(tmp_path / "2"))
    spark.sql("SELECT 'c' AS text, 1 AS other").write.parquet(str(tmp_path / "3"))
    files = [str(p) for p in tmp_path.rglob("*.parquet") if p.is_file()]
    out = {r["text"]: (r["fasttext_eli5_score"], r["meta.lang"], r["subset"]) for r in parquet.read_projected(spark, files).collect()}
    assert out == {"a": (1.5, "en", "unknown"), "b": (2.5, "de", "unknown"), "c": (None, None, "unknown")}
    assert {r["category"]: r["n"] for r in parquet.count_by_folder(spark, str(tmp_path)).collect()} == {"1": 1, "2": 1, "3": 1}
    assert parquet.footers(spark, files).count() == 3
    rows = spark.read.parquet(str(tmp_path / "1"))
    assert parquet.row_at(rows, 0)["text"] == "a"
    for bad in (-1, 1):
        with pytest.raises(ValueError):
            parquet.row_at(rows, bad)


@pytest.mark.parametrize("size", [2, 4])
def test_token_files(spark, tmp_path, size):
    path = str(tmp_path / "a.ds")
    token_files.write(path, [5, 6, 0, 7, 0, 8], size, "tok")
    with open(path, "ab") as f:
        f.write(b"\x01")
    assert token_files.metadata(path) == ("tok", size, 6)
    got = [r["tokens"] for r in token_files.read(spark, path, 0).orderBy("doc_index").collect()]
    assert got == [[5, 6, 0], [7, 0], [8]]
    assert token_files.read(spark, path, 0, first=2).count() == 2
    assert token_files.metadata(str(tmp_path / "none.ds")) == (None, 2, None)
    rows = token_files.records(spark, path, 0, lambda: lambda ids: "-".join(map(str, ids)), 2).orderBy("doc_index").collect()
    assert [r["decoded"] for r in rows] == ["5-6-0", "7-0"] and (rows[0]["tokenizer"], rows[0]["token_count"]) == ("tok", 6)
    os.remove(f"{path}.metadata")
    with pytest.raises(ValueError):
        token_files.records(spark, path, 0)


def test_row_group_sample_and_arrays(spark, tmp_path):
    pq.write_table(pa.table({"k": list(range(30))}), str(tmp_path / "g.parquet"), row_group_size=10)
    got = sorted(r["line_number"] for r in parquet.sample_group(spark, str(tmp_path / "g.parquet"), 3, 4).collect())
    assert len(got) == 4 and got[0] % 10 == 0 and got == list(range(got[0], got[0] + 4))
    parquet.write_npy(spark.range(20).coalesce(2), "id", str(tmp_path / "npy"))
    assert sorted(int(v) for f in (tmp_path / "npy").iterdir() for v in np.load(f)) == list(range(20))


@pytest.mark.parametrize("step", [1, 2, 3, 100])
def test_token_ranges(spark, tmp_path, step):
    path = str(tmp_path / "a.ds")
    token_files.write(path, [0, 5, 6, 0, 7, 0, 0, 8, 9, 9, 9, 9, 0, 4], 2, "tok")
    docs = [[0], [5, 6, 0], [7, 0], [0], [8, 9, 9, 9, 9, 0], [4]]
    got = [(r["doc_index"], r["tokens"]) for r in token_files.read(spark, path, 0, range_tokens=step).orderBy("doc_index").collect()]
    assert got == list(enumerate(docs))
    assert [r["tokens"] for r in token_files.read(spark, str(tmp_path), 0, first=3).orderBy("doc_index").collect()] == docs[:3]


def test_long_streams_by_buckets(spark):
    df = spark.sql("SELECT id % 2 AS g, id AS o, if(id % 7 = 0, 0, id % 5 + 1) AS t FROM range(2000)")
    plain = sorted(map(str, token_files.documents_of(df, "g", "o", "t", 0).collect()))
    assert plain == sorted(map(str, token_files.documents_of(df, "g", "o", "t", 0, window_rows=10).collect()))


def test_end_id(tmp_path):
    (tmp_path / "t.json").write_text('{"model": {"vocab": {"a": 1, "</s>": 2}}, "added_tokens": [{"id": 9, "content": "<|endoftext|>"}]}')
    assert token_files.end_id("t", str(tmp_path)) == 9
    (tmp_path / "u.json").write_text('{"model": {"vocab": {"a": 1}}}')
    for name in ("u", "none"):
        with pytest.raises(ValueError):
            token_files.end_id(name, str(tmp_path))


def test_numbered_files_of_many_splits(spark, tmp_path):
    text = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("\n".join(text))
    (tmp_path / "b.jsonl").write_text("only\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = jsonl.numbered_files(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["line_number"]: r["line"] for r in rows if r["file"].endswith("a.jsonl")} == dict(enumerate(text))
    assert len(rows) == 3001


def test_salvage_of_several_files(spark, damaged, tmp_path):
    path, _ = damaged
    pq.write_table(pa.table({"k": [7], "extra": ["x"]}), str(tmp_path / "e.parquet"))
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 no footer PAR1")
    paths = [path, str(tmp_path / "e.parquet"), str(tmp_path / "broken.parquet")]
    rows = recovery.salvage(spark, paths)
    assert rows.columns == ["k", "v", "extra"] and rows.count() == 4001
    assert {r["status"]: r["row_groups"] for r in recovery.summary(recovery.report(spark, paths)).collect()} == {"full": 4, "partial": 1, "unreadable": 1}
    pq.write_table(pa.table({"k": ["text"]}), str(tmp_path / "odd.parquet"))
    with pytest.raises(ValueError, match="column k"):
        recovery.salvage(spark, [path, str(tmp_path / "odd.parquet")])
    assert recovery.check_magic(f"file://{path}")["magic_ok"]


def test_no_cap_on_tasks(spark):
    from siltstone.sources import storage

    assert storage.path_table(spark, [f"/x/{i}" for i in range(64 * 700)]).rdd.getNumPartitions() == 700
