import pytest

from siltstone.llm import language, ppm, segment

TEXTS = {
    "en": "the house on the hill was empty when they came back from the long walk. nobody knew where the keys had been left.",
    "de": "das Haus auf dem Hügel war leer, als sie von dem langen Weg zurückkamen. niemand wusste, wo die Schlüssel geblieben waren.",
    "fr": "la maison sur la colline était vide quand ils sont revenus de la longue promenade. personne ne savait où étaient les clés.",
    "ru": "дом на холме был пуст, когда они вернулись с долгой прогулки. никто не знал, где остались ключи.",
}


def records(spark, extra=()):
    rows = [(10 * i + k, "en-GB" if lang == "en" else lang, f"{text} {text}") for k, (lang, text) in enumerate(TEXTS.items()) for i in range(12)]
    return spark.createDataFrame([*rows, *extra], "record_id bigint, `meta.lang` string, text string").selectExpr("*", "'x' AS lang", "1 AS segment", "2 AS label")


def test_mislabelled_and_mixed(spark):
    mixed = f"{TEXTS['en']} {TEXTS['de']}\nThe word Zeitgeist came up when they came back to the house."
    extra = [(900, "de", TEXTS["fr"]), (901, "xx", TEXTS["ru"]), (902, None, TEXTS["en"]), (903, "en", mixed), (903, "en", mixed), (904, "German", TEXTS["de"]),
             (905, None, None), (906, None, ""), (907, "zz", " \n"), (908, "en", "12 34 !"), (909, "fr", TEXTS["fr"] * 3000), (910, "en", TEXTS["en"] + " le mot juste was left.")]
    df = records(spark, extra)
    model = language.fit(df)
    found = {tuple(r) for r in language.mislabelled(language.languages(df, model)).collect()}
    assert found == {(900, "fr"), (901, "ru"), (902, "en"), (903, "en"), (903, "de")}
    parts = language.segments(df.filter("record_id = 903").limit(1), model).orderBy("segment").collect()
    assert [p["lang"] for p in parts] == ["en", "de", "en"] and [p["segment"] for p in parts] == [0, 1, 2]
    assert "".join(mixed[p["start"] : p["end"]] for p in parts) == mixed.replace("\n", "") and all(0.5 < p["confidence"] <= 1 for p in parts)


def test_empty_and_unlabelled(spark):
    df = records(spark)
    model = language.fit(df.limit(0))
    assert language.languages(df, model).count() == 0 and language.segments(df, model).count() == 0
    assert language.languages(df.limit(0), language.fit(df)).count() == 0


@pytest.mark.parametrize("label, code", [("en_GB", "en"), ("EN", "en"), (" English ", "en"), ("deu", "de"), ("pt-BR", "pt"), ("und", None), ("", None), (None, None), ("xx", None)])
def test_labels(spark, label, code):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(language.normalized(df["l"])).first()[0] == code


def test_code_lengths_are_those_of_the_method():
    model = ppm.train({"en": {"aab": 2, "ab": 1}}, ["en"])
    # Brute force: escape method C with contexts of up to ORDER bytes that begin at the word.
    counts = {}
    for word, n in {"aab": 2, "ab": 1}.items():
        coded = f" {word} ".encode()
        for i in range(1, len(coded)):
            for low in range(max(0, i - ppm.ORDER), i + 1):
                counts.setdefault(coded[low:i], {}).setdefault(coded[i], 0)
                counts[coded[low:i]][coded[i]] += n

    def share(context, byte):
        seen = counts.get(context)
        rest = (lambda: share(context[1:], byte)) if context else (lambda: 1 / 256)
        if seen is None:
            return rest()
        total = sum(seen.values()) + len(seen)
        return seen[byte] / total if byte in seen else len(seen) / total * rest()

    import math

    for word in ("aab", "ab", "ba", "zz"):
        coded = f" {word} ".encode()
        expected = sum(-math.log2(share(coded[max(0, i - ppm.ORDER) : i], coded[i])) for i in range(1, len(coded)))
        assert abs(model.word_bits(word)[0] - expected) < 1e-4


def test_sentences():
    text = "One. Two! (Three?) 3.5 four\nfive"
    starts = segment.Layout([text, None, "x — y. z"]).sentence_starts().tolist()
    assert [text[a:b].strip() for a, b in zip(starts, starts[1:])][:4] == ["One.", "Two!", "(Three?)", "3.5 four"]
