from siltstone.operators.joins import PARTS, hot_join, spread_join


def test_hot_and_null_keys(spark):
    big = spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE 'k' || least(id % 7, 2) END AS k FROM range(900)")
    small = spark.createDataFrame([("k0", 10), ("k1", 11), (None, 12)], "k string, v int")
    got = {r["id"]: r["v"] for r in spread_join(big, small, ["k"], by=["id"], how="left").collect()}
    assert len(got) == 900
    assert all(got[i] == (12 if i % 3 == 0 else {0: 10, 1: 11}.get(i % 7)) for i in range(900))
    assert spread_join(big, small, ["k"], by=["id"]).count() == sum(v is not None for v in got.values())


def test_no_task_gets_a_whole_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.sql("SELECT id, if(id % 3 = 0, 'hot', 'k' || id) AS k FROM range(30000)")
        small = spark.createDataFrame([("hot", 1)], "k string, v int")
        joined = spread_join(big, small, ["k"], by=["id"])
        sizes = [r[1] for r in joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert sum(sizes) == 10000 and max(sizes) < 8000 and PARTS > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_join(spark):
    big = spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 1.5D ELSE CAST(id AS DOUBLE) END AS v FROM range(3000)")
    small = big.filter("v is not null").groupBy("v").count().selectExpr("v", "count AS n", "v * 2 AS twice")
    got = {r["id"]: (r["v"], r["twice"]) for r in hot_join(big, small, ["v"], "n > 100", by=["id"]).collect()}
    assert len(got) == 3000
    assert all(t == (v * 2 if v is not None else None) for v, t in got.values())
    assert hot_join(big.limit(0), small, ["v"], "n > 100", by=["id"]).count() == 0
    missing = hot_join(big, small.filter("v > 10"), ["v"], "n > 100", by=["id"])
    assert missing.filter("v = 1.5 and twice is null").count() == 1000


def test_hot_and_null_keys_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 1.5D ELSE CAST(id AS DOUBLE) END AS v FROM range(30000)").repartition(4)
        small = big.filter("v is not null").groupBy("v").count().selectExpr("v", "count AS n")
        joined = hot_join(big, small, ["v"], "n > 1000", by=["id"])
        sizes = [r[1] for r in joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 10000  # a third of the rows have one value, another third none
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
