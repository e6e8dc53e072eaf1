import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import records, selector

RECORD = {"info": {"title": "t", "weird.key": 1, "0": "zero"}, "messages": [{"parts": [{"text": "a"}, {"text": "b"}]}, {"parts": []}, 5], "n": None, "f": 1.0}


def select(spark, value, sel):
    df = spark.createDataFrame([(1, json.dumps(value))], "id int, json string")
    return [(r["path"], json.loads(r["value"])) for r in selector.select(df, "json", sel).collect()]


@pytest.mark.parametrize("sel, expected", [
    ("info.title", [("info.title", "t")]),
    ("messages.[0].parts.[1].text", [("messages.[0].parts.[1].text", "b")]),
    ("messages[0].parts[].text", [("messages.[0].parts.[0].text", "a"), ("messages.[0].parts.[1].text", "b")]),
    ("messages[*].parts[0].text", [("messages.[0].parts.[0].text", "a")]),
    ('info["weird.key"]', [("info.weird.key", 1)]),
    ("info.0", [("info.0", "zero")]),
    ("info[title]", [("info.title", "t")]),
    ("n", [("n", None)]),
    ("missing", []), ("info[]", []), ("messages.0", []), ("info[0]", []),
])
def test_select(spark, sel, expected):
    assert sorted(select(spark, RECORD, sel), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("bad", ["", "  ", "a[", "a[1", 'a["x', 'a["x"', "a[-1]"])
def test_bad_selectors(bad):
    with pytest.raises(ValueError):
        selector.parse(bad)


def test_walk_keeps_order_and_types(spark):
    text = '{"b": {"y": 1.0, "x": [true, null, {}]}, "a": []}'
    df = spark.createDataFrame([(1, text), (2, None), (3, "{"), (4, "7")], "id int, json string")
    got = [tuple(r) for r in selector.walk(df, "id", "json").orderBy("id", "ordinal").collect()]
    assert got == [(1, 0, "b.y", "1.0"), (1, 1, "b.x.[0]", "true"), (1, 2, "b.x.[1]", "null"), (4, 0, "", "7")]


json_values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text("abc", min_size=1, max_size=2), c, max_size=3), max_leaves=8)


@given(json_values)
@settings(max_examples=60)
def test_leaves_resolve(value):
    for path, leaf in selector.leaves(value):
        at = value
        for part in path.split(".") if path else []:
            at = at[int(part[1:-1])] if part.startswith("[") else at[part]
        assert at == leaf


def reference_truncation(s):
    parts = s.splitlines()
    if len(s) <= 4000 and len(parts) <= 12:
        return s
    return "\n".join(parts[:12])[:4000] + f"\n\n… [truncated: {len(parts)} lines, {len(s)} chars; showing up to 12 lines / 4000 chars]"


def test_truncate_text(spark):
    texts = ["", "a", "a\n", "\n" * 12, "\n" * 13, "x\r\ny\rz\x0b\x0c\x1c\x1d\x1e\x85  " * 3, "é" * 4000, "é" * 4001, "a\n" * 30 + "b", ("z" * 999 + "\n") * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", records.truncate_text(F.col("t")).alias("s")).collect()}
    assert got.pop(99) is None
    assert got == {i: reference_truncation(t) for i, t in enumerate(texts)}


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2, 'y', named_struct('z', 3)) AS m, 4 AS `m.x`")
    out = records.flatten(df)
    assert out.columns == ["a", "m.x", "m.y"] and out.first()[1] == 4 and out.first()["m.y"]["z"] == 3


def test_json_line(spark):
    df = spark.sql("SELECT cast(0.1 AS float) AS f, double('NaN') AS n, cast(null AS string) AS s, array(double('Infinity'), 1D) AS a, timestamp'2024-01-02 03:04:05.000006' AS t, named_struct('q', float('NaN')) AS st")
    got = json.loads(df.select(records.json_line(df)).first()[0])
    assert got["n"] is None and got["s"] is None and got["a"] == [None, 1.0] and got["st"] == {"q": None} and got["t"].endswith(".000006")
    assert math.isclose(got["f"], 0.10000000149011612, rel_tol=0, abs_tol=0)
    for bad in ("cast('x' AS binary)", "cast(1 AS decimal(5,2))", "array(cast('x' AS binary))"):
        frame = spark.sql(f"SELECT {bad} AS c")
        with pytest.raises(ValueError):
            records.json_line(frame)


def test_small_expressions(spark):
    row = spark.sql("SELECT array(1, 3, 3) AS a, cast(array() AS array<int>) AS e, 'x\ny\rz' AS t, cast(null AS string) AS u").select(
        records.argmax(F.col("a")), records.argmax(F.col("e")), records.one_line(F.col("t")), records.prompt(F.col("t"), F.col("u"))
    ).first()
    assert tuple(row) == (1, None, "x y z", "\n\nx\ny\rz")


def test_decorate_overwrites(spark):
    out = records.decorate(spark.sql("SELECT 1 AS filename, 2 AS a"), "f.jsonl", F.lit(3))
    assert out.columns == ["a", "filename", "line_number"] and tuple(out.first()) == (2, "f.jsonl", 3)
