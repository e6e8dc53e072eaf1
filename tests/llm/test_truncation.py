import random

from siltstone.llm import truncation

NOUNS = ["photon", "enzyme", "verdict", "statute", "dividend", "mortgage", "saucepan", "marinade", "itinerary", "passport"]
FRAMES = ["Compared with the {a}, the {b} is easy to explain.", "Without the {a}, the whole {b} would have to start again.", "Some prefer the {a} because it explains the {b} sooner.", "The {a} has changed little, although everyone now prefers the {b}."]
ENDS = ["", "", "\n\nFiled under: {a}", "\n[1] [2] [3]", "\n\nTHE END", "\nTo be continued...", "\n\n## See also\n- {a}\n- {b}"]


def corpus(seed=1, n=1500):
    rnd = random.Random(seed)
    rows, cut = [], set()
    for i in range(n):
        pair = lambda: dict(zip("ab", rnd.sample(NOUNS, 2)))
        text = " ".join(rnd.choice(FRAMES).format(**pair()) for _ in range(rnd.randrange(3, 8)))
        if rnd.random() < 0.1:
            at = rnd.randrange(len(text) // 2, len(text) - 8)
            while text[at - 1] in ".," or text[at - 2] == ".":
                at -= 1
            text = text[:at] + rnd.choice(["", "", "…", " [more]", "… Read more", "�", "<!-- connection reset"])
            cut.add(i)
        else:
            text += rnd.choice(ENDS).format(**pair())
            if rnd.random() < 0.1 and text.endswith("."):
                text = text[:-1]  # whole without a final full stop
        rows.append((i, text, rnd.choice(["x", "x", "y", None])))
    return rows, cut


def test_found(spark):
    rows, cut = corpus()
    extra = [(5000, None, "x"), (5001, "", "x"), (5002, " \r\n", "x"), (5003, "!!!", None), (5004, rows[0][1] * 300, "y"), (5005, "R&D", "y"), (5006, "Mortgage and verdict", "y")]
    df = spark.createDataFrame([*rows, *extra], "doc_id bigint, text string, source string").selectExpr("*", "'x' AS a", "1 AS n", "2 AS cut", "'y' AS _key")
    found = [r["doc_id"] for r in truncation.verdicts(df).filter("cut").select("doc_id").collect()]
    assert len(found) == len(set(found))
    assert len(set(found) & cut) >= 0.97 * len(cut), sorted(cut - set(found))[:5]
    assert len(set(found) - cut) <= 0.03 * len(cut), [dict((r[0], r[1]) for r in rows + extra)[i][-60:] for i in set(found) - cut][:8]
    rates = {r["source"]: r for r in truncation.rates(truncation.verdicts(df)).collect()}
    assert sum(r["cut"] for r in rates.values()) == len(found) and None in rates


def test_copies(spark):
    """A cut text is found however often it occurs."""
    rows, _ = corpus()
    whole = [r for r in rows if r[1].endswith(".")]
    cut = {2: "Some prefer the photon because it explains the", 50: "The statute has changed little, although everyone", 7: "Without the enzyme, the whole dividend would have to sta"}
    copies = [(10_000 * n + i, text, "x") for n, text in cut.items() for i in range(n)]
    df = spark.createDataFrame([*whole, *copies], "doc_id bigint, text string, source string")
    found = {r["doc_id"] for r in truncation.verdicts(df).filter("cut").select("doc_id").collect()}
    assert found >= {r[0] for r in copies}
    assert not found & {r[0] for r in whole}


def test_ends_of_any_length(spark):
    """Padding, marks and words at the end are judged however long they are."""
    rows, _ = corpus()
    whole = [r for r in rows if r[1].endswith(".")]
    start, run = "Some prefer the photon because it explains the", "ab" * 400
    cut = [start, start + " " * 400, start + "\n" * 400, start + " " + "· " * 400, start + " <!-- " + "lost " * 100, start + "<!-- lost" + " " * 100]
    cut += [start + " [" + " " * 100 + "more" + " " * 100_000 + "]", "Whole. <!-- " + "lost " * 100 + "-->", "Behind it stood " + run]
    kept = ["Whole <!-- " + "lost " * 100 + "--> again.", "A whole one." + " " * 400]
    more = [(9000 + i, f"Behind it stood {run}{tail} once.", "x") for i, tail in enumerate(["ba", "bb", "bc"])]
    df = spark.createDataFrame([*whole, *more, *[(7000 + i, t, "x") for i, t in enumerate(cut)], *[(8000 + i, t, "x") for i, t in enumerate(kept)]], "doc_id bigint, text string, source string")
    found = {r["doc_id"] for r in truncation.verdicts(df).filter("cut").select("doc_id").collect()}
    assert sorted(i for i in found if 7000 <= i < 8000) == [7000 + i for i in range(len(cut))]
    assert not [i for i in found if i < 7000 or i >= 8000]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert truncation.verdicts(df).count() == 0


def test_copies_by_either_way(spark, monkeypatch):
    """Listed copies, too many of them, and copies that share a key or have none give the same verdicts."""
    rows, _ = corpus()
    whole = [r for r in rows if r[1].endswith(".")]
    cut = "Some prefer the photon because it explains the"
    copies = [(10_000 + i, cut, "x") for i in range(40)]
    schema = "doc_id bigint, text string, source string"
    found = lambda more: sorted(map(str, truncation.verdicts(spark.createDataFrame([*whole, *more], schema)).filter("cut").collect()))
    listed = found(copies)
    assert len(listed) >= 40
    shared = found([*copies, (10_000, cut, "x"), (None, cut, "x")])
    assert len(shared) == len(listed) + 2 and set(shared) >= set(listed)
    monkeypatch.setattr(truncation._once, "__defaults__", (3,))
    assert found(copies) == listed
