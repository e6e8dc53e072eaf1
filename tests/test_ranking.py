import random

from siltstone.operators.ranking import cumulative, numbered


def brute(rows, buckets=None):
    groups = {}
    for k, v, w in rows:
        groups.setdefault(k, {}).setdefault(v, 0)
        groups[k][v] += w
    out = set()
    for k, values in groups.items():
        before = 0
        for v in sorted(values):
            out.add((k, v, values[v], before, sum(values.values())))
            before += values[v]
    return out


def run(spark, rows, buckets=8):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "k string, v double, w bigint")
    return {tuple(r) for r in cumulative(df, ["k"], "v", F.col("w"), buckets).collect()}


def test_hot_group_ties_and_null_key(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), float(rnd.randrange(40)), rnd.randrange(5)) for _ in range(2000)]
    rows += [("c", 7.0, 1)] * 500  # one value, many rows
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, 2) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == set()


def test_without_keys(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,)], "v double")
    assert sorted(map(tuple, cumulative(df, [], "v").collect())) == [(1.0, 2, 0, 3), (3.0, 1, 2, 3)]


def test_size_checked_broadcast(spark):
    from siltstone.plans.lineage import broadcast_if_small

    df = spark.range(5)
    plan = lambda side: spark.range(9).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert broadcast_if_small(df, 4) is df
    assert "strategy=broadcast" in plan(broadcast_if_small(df, 5))
    assert broadcast_if_small(df.limit(0)).count() == 0


def test_numbered_is_the_row_number(spark):
    df = spark.sql("SELECT CAST(hash(id) AS STRING) AS s, if(id % 3 = 0, 1, id) AS hot FROM range(1000)")
    got = numbered(df, "hot", "s").orderBy("row_number").collect()
    assert [r["row_number"] for r in got] == list(range(1000))
    assert [(r["hot"], r["s"]) for r in got] == [(r["hot"], r["s"]) for r in df.orderBy("hot", "s").collect()]
    assert numbered(df.limit(0), "s").count() == 0


def test_buckets_share_a_hot_group(spark):
    """A group with nine tenths of the rows is cut into buckets of like size; its sums stay exact."""
    df = spark.sql("SELECT if(id % 10 = 0, id % 7, -1) AS g, CAST(id AS DOUBLE) AS v FROM range(20000)")
    got = {(r["g"], r["v"]): (r["n_before"], r["n_group"]) for r in cumulative(df, ["g"], "v").collect()}
    hot = sorted(v for g, v in got if g == -1)
    assert len(hot) == 18000 and all(got[-1, v] == (i, 18000) for i, v in enumerate(hot))
