import random

import pytest

from siltstone.llm import bpe, segment, tokens

tokenizers = pytest.importorskip("tokenizers")
PIECES = ["a", "b", "'", "s", "t", "re", "ve", "ll", "d", "'s", " ", "  ", "\n", "\r\n", "\t", "1", "२", "é", "é", "漢", "字", "😀", "‍", "½", "_", "-", ".", "!", "\x00", " ", "　", "\x85", "<|endoftext|>", "Straße", "don't", "WE'RE"]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{bpe.VOCABULARY_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_against_the_public_library(reference):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(60))) for _ in range(5000)]
    texts += ["", " ", "\n", "'", "''s", " 'll", "x" * 20_000, "ab " * 20_000, "é" * 3_000, " " * 5_000 + "x"]
    ids, offsets = bpe.load().encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == reference(texts)
    e = bpe.load()
    assert [e.decode(x) for x in got] == texts  # exact round trip


def test_null_and_empty():
    ids, offsets = bpe.load().encode([None, "", "a", None])
    assert offsets.tolist() == [0, 0, 0, 1, 1] and len(ids) == 1
    assert bpe.load().encode([])[1].tolist() == [0]


def test_batches_never_cut_texts():
    texts = ["x" * 50, None, "y" * 500, "", "z" * 50]
    spans = list(segment.sub_batches(texts, 100))
    assert spans[0][0] == 0 and spans[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_ids_query(spark, reference):
    rows = [(1, "one two"), (1, "one two"), (2, None), (None, ""), (3, "it's " * 3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'clash' AS ids", "1 AS n_tokens")
    got = sorted(((r["doc_id"], r["ids"]) for r in tokens.ids(df).collect()), key=str)
    assert got == sorted([(k, reference([t or ""])[0]) for k, t in rows], key=str)
    assert tokens.ids(df.limit(0)).count() == 0
    counted = {r["doc_id"]: r["n_tokens"] for r in tokens.counts(df.selectExpr("doc_id", "text", "text AS _text", "n_tokens")).collect()}
    assert counted[2] == 0 and counted[None] == 0 and counted[3] == len(reference(["it's " * 3000])[0])


def records(spark, rows):
    return spark.createDataFrame(rows, "record_id bigint, subset string, `meta.lang` string, `meta.domain` string, jais_token_count bigint, `meta.token_count` bigint, text string, n_tokens string")


def test_wrong_counts_and_budget(spark):
    text = "the old mill by the river was quiet that year "
    own = int(bpe.load().count([text])[0])
    rows = [(i, "s", "en-US", "d", 2 * own, None, text, "x") for i in range(30)]
    rows += [(40, "s", "en", "d", 9 * own, None, text, "x"), (41, None, "en", None, own // 3, None, text, "x"), (42, "s", "en", "d", None, None, text, "x")]
    rows += [(43, "s", "en", "d", 10**9, None, None, "x"), (44, "s", "en", "d", -1, None, "", "x"), (0, "s", "en-US", "d", 2 * own, None, text, "x"), (45, "s", None, "d", 5, 5, text, "x")]
    counted = tokens.record_counts(records(spark, rows))
    assert {r["record_id"] for r in tokens.wrong_counts(counted).collect()} == {40, 41}
    total = tokens.budget(counted).filter("level = 7").first()
    assert total["records"] == 36 and total["n_tokens"] == own * 34 and total["jais_tokens"] == 2 * own * 33 + 5
    assert tokens.wrong_counts(tokens.record_counts(records(spark, []))).count() == 0


def test_scan_is_the_automaton():
    import random

    import numpy as np

    from siltstone.llm import segment

    rnd = random.Random(2)
    for n in (0, 1, 5, 64, 65, 5000):
        functions = np.array([[rnd.randrange(4) for _ in range(4)] for _ in range(n)], dtype=np.uint8).reshape(n, 4)
        state, expected = 0, []
        for row in functions.tolist():
            expected.append(state)
            state = row[state]
        assert segment.scan(functions).tolist() == expected
        assert segment.scan(functions, width=3).tolist() == expected


def test_offsets_decode_by_position(spark):
    texts = ["I'll say: don't, they're  here'dx ''s 's", "", None, "Ünïcode   ’s  x\n\n y 123abc"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    encoder = bpe.load()
    for r in tokens.ids(df, offsets=True).collect():
        text = texts[r["doc_id"]] or ""
        assert len(r["starts"]) == len(r["ids"]) and r["starts"] == sorted(r["starts"])
        bounds = sorted(set(r["starts"])) + [len(text)]
        for a, b in zip(bounds, bounds[1:]):
            assert encoder.decode_between(r["ids"], r["starts"], a, b) == text[a:b]
        assert encoder.decode_between(r["ids"], r["starts"], 0, len(text) + 1) == text


def test_exact_median_and_null_ids(spark):
    rows = [(i, "a", "en", "d", True, g, None, 10) for i, g in enumerate([10, 20, 30, 40])] + [(None, "a", "en", "d", True, 20, None, 10)] * 3
    counted = spark.createDataFrame(rows, "record_id bigint, source string, lang string, domain string, has_text boolean, jais_token_count bigint, meta_tokens bigint, n_tokens bigint")
    assert [tuple(r) for r in tokens.rates(counted).collect()] == [("en", 2.0)]
    total = tokens.budget(counted).filter("level = 7").first()
    assert (total["records"], total["n_tokens"]) == (7, 70)
