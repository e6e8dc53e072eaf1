import random

from siltstone.llm import topics

AREAS = {0: ["photon", "enzyme", "galaxy", "neutron"], 1: ["verdict", "statute", "plaintiff", "appeal"], 5: ["dividend", "mortgage", "audit", "broker"]}
FRAMES = ["the {a} and the {b} belong together", "without the {a} the {b} would have to start again", "nobody expected the {a} near the {b}"]
NEUTRAL = ["it took longer than anyone had planned", "there is more to come in the summer"]


def sentence(rnd, area):
    a, b = rnd.sample(AREAS[area], 2)
    return rnd.choice(FRAMES).format(a=a, b=b) + "."


def corpus(rnd, n=400):
    rows, truth = [], {}
    for i in range(n):
        main = rnd.sample(list(AREAS), rnd.choice([1, 1, 2]))
        parts = [sentence(rnd, a) for a in main for _ in range(rnd.choice([2, 3]))]
        side = [a for a in AREAS if a not in main]
        if rnd.random() < 0.4:
            parts.append(sentence(rnd, rnd.choice(side)))  # one sentence on the side
        parts += [rnd.choice(NEUTRAL) + "."] * rnd.choice([0, 1])
        rnd.shuffle(parts)
        rows.append((i, " ".join(parts), rnd.choice([main[0]] * 8 + [None, side[0]])))
        truth[i] = set(main)
    return rows, truth


def test_held_out_accuracy(spark):
    rnd = random.Random(4)
    rows, truth = corpus(rnd)
    extra = [(900, None, 1), (901, "", 0), (902, "  \n", None), (903, (sentence(rnd, 5) + " ") * 5000, None), (None, sentence(rnd, 0) * 2, 77)]
    df = spark.createDataFrame([*rows, *rows[:20], *extra], "record_id bigint, text string, TopicClassifier bigint").selectExpr("*", "1 AS topic_id", "2 AS areas", "3 AS weight")
    labels = spark.createDataFrame([(i, a) for i in range(0, 60) for a in truth[i]] + [(None, 0), (5, None), (5, 99)], "record_id bigint, topic_id bigint")
    factor = topics.fit(df, labels, list(AREAS))
    got = topics.subjects(topics.mixtures(df, factor, list(AREAS))).collect()
    assert len(got) == len(set(got))
    found = {(r["record_id"], r["topic_id"]) for r in got if r["record_id"] is not None and 60 <= r["record_id"] < 900}
    true = {(i, a) for i, t in truth.items() if i >= 60 for a in t}
    assert len(found & true) >= 0.98 * len(true) and len(found - true) <= 0.02 * len(true)
    assert {(r["record_id"], r["topic_id"]) for r in got if r["record_id"] and r["record_id"] >= 900} == {(903, 5)}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "the photon and the enzyme", None)], "record_id bigint, text string, TopicClassifier bigint")
    labels = spark.createDataFrame([], "record_id bigint, topic_id bigint")
    for areas in ([0, 1], []):
        assert topics.mixtures(df, topics.fit(df, labels, areas), areas).count() == 0
    assert topics.mixtures(df.limit(0), topics.fit(df.limit(0), labels, [0]), [0]).count() == 0
