import math
import random
from fractions import Fraction

from siltstone.llm import ranking

S = ranking.SCORES
SCHEMA = "record_id bigint, subset string, " + ", ".join(f"{s} double" for s in S) + ", value string, share string, n string, vector string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "v", "s", "n", "x") for r in rows], SCHEMA)


def rows_of(seed, n=300):
    rnd = random.Random(seed)
    bad = lambda v: rnd.choice([v] * 8 + [None, math.nan])
    rows = [(i, rnd.choice(["a", "a", "a", "b", None, "unknown"]), bad(rnd.gauss(1, 3)), bad(rnd.choice([0.5, rnd.random() ** 4])), bad(round(rnd.random(), 1))) for i in range(n)]
    return rows + rows[: n // 5]  # repeated rows


def shares(rows):
    values = {i: [v if v is not None and not math.isnan(v) else None for v in r[2:]] for i, r in {r[0]: r for r in rows}.items()}
    out = {}
    for i, own in values.items():
        vector = []
        for k, v in enumerate(own):
            column = [w[k] for w in values.values() if w[k] is not None]
            vector.append(0.0 if v is None else (sum(w < v for w in column) + sum(w == v for w in column) / 2) / len(column))
        out[i] = sorted(vector)
    return out


def test_leximin(spark):
    rows = rows_of(1)
    rnd = random.Random(2)
    lists = [(k, rnd.randrange(300)) for k in range(40) for _ in range(6)] * 2 + [(50, 9999), (None, 3), (51, None), (52, 7), (52, 9999)]
    df, asked = make(spark, rows), spark.createDataFrame(lists, "list_id bigint, record_id bigint")
    vectors = shares(rows)
    expected = {}
    for k, i in lists:
        if k is not None and i in vectors:
            expected[k] = max(expected.get(k, i), i, key=lambda x: (vectors[x], -x))
    assert {r["list_id"]: r["record_id"] for r in ranking.best_of_lists(df, asked).collect()} == expected
    got = {r["record_id"]: r["position"] for r in ranking.ranking(df).collect()}
    assert got == {i: 1 + sum(w > v for w in vectors.values()) for i, v in vectors.items()}


def test_cutoffs(spark):
    rows = rows_of(3)
    targets = [(1, "a", S[0], 0.1), (2, "b", S[1], 0.33), (3, "unknown", S[2], 0.5), (4, None, S[2], 0.5), (5, "none", S[0], 0.5), (6, "a", "other", 0.5), (7, "a", S[1], 1.0), (8, "b", S[0], 0.0)]
    df, asked = make(spark, rows), spark.createDataFrame(targets, "target_id int, subset string, score_name string, target_fraction double")
    expected, kept = {}, set()
    for t, subset, score, fraction in targets:
        k = S.index(score) + 2 if score in S else None
        own = {r[0]: r[k] for r in rows if k and (r[1] or "unknown") == (subset or "unknown") and r[k] is not None and not math.isnan(r[k])}
        enough = [v for v in own.values() if sum(w >= v for w in own.values()) >= Fraction(str(fraction)) * len(own)]
        cut = max(enough, default=None)
        members = {(t, i) for i, v in own.items() if cut is not None and v >= cut}
        expected[t] = (len(own), cut, len(members))
        kept |= members
    assert {r["target_id"]: (r["n_counted"], r["cutoff"], r["n_kept"]) for r in ranking.cutoffs(df, asked).collect()} == expected
    got = [tuple(r) for r in ranking.kept(df, asked).collect()]
    assert set(got) == kept and len(got) == len(kept)


def test_empty(spark):
    df = make(spark, [])
    lists = spark.createDataFrame([(1, 2)], "list_id bigint, record_id bigint")
    targets = spark.createDataFrame([(1, "a", S[0], 0.5)], "target_id int, subset string, score_name string, target_fraction double")
    assert ranking.best_of_lists(df, lists).count() == 0 and ranking.kept(df, targets).count() == 0
    row = ranking.cutoffs(df, targets).first()
    assert (row["n_counted"], row["cutoff"], row["n_kept"]) == (0, None, 0)
    assert ranking.kept(make(spark, rows_of(4)), targets.limit(0)).count() == 0 and ranking.ranking(df).count() == 0
