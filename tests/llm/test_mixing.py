import random

import pytest

from siltstone.llm import mixing


def setup(spark, seed=1, n=400):
    rnd = random.Random(seed)
    docs = [(i, rnd.choice(["a", "a", "a", "a", "b", "b", "c", None]), rnd.choice([0, 5, 10, 200])) for i in range(n)]
    targets = [(1, "a", 0.5, 1, 1.0), (1, "b", 0.3, 3, 1.0), (1, "c", 0.2, 1, 1.0), (2, "b", 0.9, 8, 0.5), (2, "none", 0.1, 4, 0.5), (3, "a", 1.0, 0, 1.0)]
    sized = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint").selectExpr("*", "'x' AS position", "1 AS demand", "2 AS mix_id")
    return docs, targets, sized, spark.createDataFrame(targets, "mix_id int, source string, target_share double, max_repeats int, total_multiple double")


@pytest.mark.parametrize("tilt", [0.0, 0.5, 0.9])
def test_mix(spark, tilt):
    docs, targets, sized, asked = setup(spark)
    total = sum(n for _, _, n in docs)
    drawn, plan = mixing.draws(sized, asked, tilt)
    rows = drawn.collect()
    by = {}
    for r in rows:
        by.setdefault((r["mix_id"], r["source"]), []).append(r)
    for mix, source, share, repeats, multiple in targets:
        own = {i: n for i, s, n in docs if s == source and n}
        demand = share * multiple * total
        got = by.get((mix, source), [])
        uses = {}
        for r in got:
            uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
            assert 0 <= r["position"] < 1
        assert all(u <= repeats and d in own for d, u in uses.items())
        size = sum(r["n_tokens"] for r in got)
        if sum(own.values()) * repeats >= demand:
            assert demand <= size < demand + max(own.values())
            assert max(uses.values()) - min(list(uses.values()) if len(uses) == len(own) else [0]) <= 1
        else:
            assert size == sum(own.values()) * repeats
    report = {(r["mix_id"], r["source"]): r for r in mixing.shares(drawn, plan).collect()}
    capacity = {(m, s): sum(n for _, x, n in docs if x == s) * k for m, s, _, k, _ in targets}
    assert {k for k, r in report.items() if r["short"]} == {(m, s) for m, s, share, _, mult in targets if capacity[m, s] < share * mult * total}
    assert abs(sum(r["reached_share"] for k, r in report.items() if k[0] == 1) - 1) < 1e-9 and report[3, "a"]["reached_share"] is None


def test_schedule_follows_the_weights(spark):
    docs = [(i, "a" if i % 4 else "b", 10) for i in range(4000)]
    sized = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    asked = spark.createDataFrame([(1, "a", 0.5, 1, 1.0), (1, "b", 0.5, 4, 1.0)], "mix_id int, source string, target_share double, max_repeats int, total_multiple double")
    drawn, plan = mixing.draws(sized, asked)
    tilt = {r["source"]: r["tilt"] for r in plan.collect()}
    assert tilt["b"] > 0 > tilt["a"] and abs(0.5 * tilt["a"] + 0.5 * tilt["b"]) < 1e-12
    rows = [r.asDict() for r in mixing.ordered(drawn).collect()]
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    for source, a in tilt.items():
        own = [r["position"] for r in rows if r["source"] == source]
        for t in (0.25, 0.5, 0.75):
            expected = t + a * (t * t - t)
            assert abs(sum(p < t for p in own) / len(own) - expected) < 0.01


def test_empty(spark):
    *_, sized, asked = setup(spark)
    drawn, plan = mixing.draws(sized.limit(0), asked)
    assert drawn.count() == 0 and not any(r["short"] for r in mixing.shares(drawn, plan).collect())
    drawn, plan = mixing.draws(sized, asked.limit(0))
    assert drawn.count() == 0 and mixing.shares(drawn, plan).count() == 0


def test_short_sources_run_out_early_and_are_stretched(spark):
    sized = spark.createDataFrame([(i, "a" if i % 2 else "b", 10) for i in range(100)] + [(7, "a", 10)], "doc_id bigint, source string, n_tokens bigint")
    asked = spark.createDataFrame([(1, "a", 0.2, 1, 1.0), (1, "b", 0.8, 1, 1.0)], "mix_id int, source string, target_share double, max_repeats int, total_multiple double")
    drawn, plan = mixing.draws(sized, asked, tilt=0.0)
    report = {r["source"]: r for r in mixing.shares(drawn, plan).collect()}
    assert report["b"]["short"] and abs(report["b"]["until"] - 500 / 808) < 1e-9
    assert not report["a"]["short"] and report["a"]["until"] >= 1
    rows = mixing.ordered(drawn, mixing.shares(drawn, plan)).collect()
    assert max(r["position"] for r in rows if r["source"] == "b") > 0.95
    assert len(rows) == drawn.count()
