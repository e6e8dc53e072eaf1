import json

import pytest

from siltstone.operators import drift

WORDS = ["the quiet river ran past the mill", "every lamp in the street was lit", "a long road leads to the harbour town"]


def lines(spark, files):
    rows = [(feed, no, i, line) for (feed, no), body in files.items() for i, line in enumerate(body)]
    return spark.createDataFrame(rows, "feed string, file_no int, line_no int, line string")


def body(n, make, seed=0):
    return [json.dumps(make(i + seed)) for i in range(n)]


def found(spark, files):
    return {tuple(r) for r in drift.changes(drift.profiles(lines(spark, files))).select("file_no", "field", "change").collect()}


def base(i):
    return {"text": WORDS[i % 3] + f" {i}", "subset": ["a_b", "c_d"][i % 2], "meta": {"token_count": 20 + 7 * i, "lang": ["en", "de", "fr"][i % 3], "batch": 101}}


def test_types_of_change(spark):
    def second(i):
        r = base(i)
        r["body"] = r.pop("text")
        r["meta"]["n_tokens"] = str(r["meta"].pop("token_count"))
        r["meta"]["ok"] = True
        del r["meta"]["batch"]
        return r

    assert found(spark, {("f", 1): body(12, base), ("f", 2): body(12, second, 3)}) == {
        (2, "body", "renamed"), (2, "meta.n_tokens", "renamed"), (2, "meta.n_tokens", "retyped"), (2, "meta.ok", "added"), (2, "meta.batch", "removed"),
    }


def test_flattened_meta_gaps_and_noise(spark):
    def flat(i):
        r = base(i)
        return {k: v for k, v in r.items() if k != "meta"} | {f"meta.{k}": v for k, v in r["meta"].items()}

    noisy = body(12, base) + ["", "   ", "{broken", "[1]", "null", '"text"', json.dumps(base(4) | {"subset": None}) + "\r"]
    odd = [json.dumps(base(i) | ({"subset": 3} if i == 5 else {})) for i in range(12)]
    assert found(spark, {("f", 1): noisy, ("f", 3): body(12, flat), ("f", 7): odd + odd}) == set()


def test_null_lines_only_bad_files_and_empty_table(spark):
    assert found(spark, {("f", 1): [None, "", "{"], ("f", 2): body(3, base)}) == set()
    assert found(spark, {("f", 1): []}) == set()


def test_unified_table(spark):
    def other(i):
        r = base(i)
        return {"Text": [r["text"], "more"], "corpus": [r["subset"]], "n_tokens": float(r["meta"]["token_count"]), "language": {"code": r["meta"]["lang"], "p": 0.9}}

    table = lines(spark, {("f", 1): body(12, base), ("f", 2): body(12, other)})
    rows = drift.unified(table, drift.canonical_names(drift.profiles(table))).collect()
    assert len(rows) == 24
    second = {r["line_no"]: r for r in rows if r["file_no"] == 2}
    assert second[4]["text"] == base(4)["text"] + " more" and second[4]["subset"] == "a_b"
    assert second[4]["meta.token_count"] == 48 and second[4]["meta.lang"] == "de"


def test_unified_keeps_files_without_wanted_fields(spark):
    table = lines(spark, {("a", 0): body(40, base), ("a", 1): ['{"zzz": true}', '{"zzz": false}', "broken"], (None, 0): body(3, base)})
    rows = drift.unified(table, drift.canonical_names(drift.profiles(table))).collect()
    new = [tuple(r) for r in rows if r["file_no"] == 1]
    assert sorted(new) == [("a", 1, 0, None, None, None, None), ("a", 1, 1, None, None, None, None)]
    assert len(rows) == 42 and all(r["text"] for r in rows if r["file_no"] == 0)


def test_lattice():
    assert drift.promote("integer", "number") == "number"
    assert drift.promote("boolean", "integer") == "string"
    assert drift.promote("array", "array") == "array"
    for a in drift.TYPES:
        for b in drift.TYPES:
            assert drift.promote(a, b) == drift.promote(b, a)
            for c in drift.TYPES:
                assert drift.promote(drift.promote(a, b), c) == drift.promote(a, drift.promote(b, c))


def test_union_schema(spark):
    table = lines(spark, {("f", 1): ['{"a": 1}', '{"a": 2, "b": [1]}'], ("f", 2): ['{"a": 1.5, "b": null}'], ("g", 1): ['{"c": true}']})
    got = {r["field"]: (r["type"], r["spark_type"], r["files"]) for r in drift.union_schema(drift.profiles(table)).collect()}
    assert got == {"a": ("number", "double", 2), "b": ("array", "string", 2), "c": ("boolean", "boolean", 1)}


def test_union_schema_counts_feeds_exactly(spark):
    table = lines(spark, {(f"feed {i}", 0): ['{"text": "a"}'] for i in range(700)})
    assert [(r["files"], r["feeds"]) for r in drift.union_schema(drift.profiles(table)).collect()] == [(700, 700)]



@pytest.mark.parametrize("line, ok", [("{}", True), ('{"a": NaN}', False), ("", False), (None, False), ("1", False), ('{"a":1}\r', True)])
def test_parse(line, ok):
    assert (drift.parse(line) is not None) == ok


def test_values_that_do_not_fit_are_null(spark):
    values = ['12', '"12"', '12.0', '12.7', '1e30', '"NaN"', '9007199254740993', '"x"', 'null', '-1e400', '99999999999999999999']
    first = [json.dumps(base(i)) for i in range(12)]
    table = lines(spark, {("f", 1): first, ("f", 2): ['{"text": "a b c", "meta": {"token_count": %s}}' % v for v in values]})
    rows = drift.unified(table, drift.canonical_names(drift.profiles(table))).filter("file_no = 2").orderBy("line_no").collect()
    assert [r["meta.token_count"] for r in rows] == [12, 12, 12, None, None, None, 9007199254740993, None, None, None, None]


@pytest.mark.parametrize("union", drift.TYPES)
def test_cast_through_the_union_type(spark, union):
    row = spark.createDataFrame([("7.0", "8", "x", None)], "a string, b string, c string, d string").select(
        *[drift.cast_through(drift.F.col(c), union, "bigint").alias(c) for c in "abcd"]
    ).first()
    assert row["b"] == 8 and row["c"] is None and row["d"] is None
    assert row["a"] in ((7,) if union not in ("integer", "boolean") else (7, None))


def test_twice_delivered_lines_and_held_profiles(spark, monkeypatch):
    table = lines(spark, {("f", 1): body(12, base), ("f", 2): body(12, base)}).unionAll(lines(spark, {("f", 2): body(12, base)}))
    assert drift.once(table).count() == 24
    plain = sorted(map(tuple, drift.profiles(table).collect()))
    monkeypatch.setattr(drift, "HELD_PROFILES", 1)
    split = sorted(map(tuple, drift.profiles(table.repartition(5)).collect()))
    assert [p[:11] for p in split] == [p[:11] for p in plain]


def test_promoted_type_in_the_log(spark):
    table = lines(spark, {("f", 1): ['{"a": 1}'] * 3, ("f", 2): ['{"a": 1.5}'] * 3, ("f", 3): ['{"a": true}'] * 3})
    got = [(r["change"], r["previous_type"], r["type"], r["promoted_type"]) for r in drift.changes(drift.profiles(table)).orderBy("file_no").collect()]
    assert got == [("retyped", "integer", "number", "number"), ("retyped", "number", "boolean", "string")]
