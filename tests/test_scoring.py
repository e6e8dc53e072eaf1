import json
import struct

import pytest

from siltstone.operators import scoring
from siltstone.plans.runtime import Meter


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(**fields):
    """Protocol buffer with fields named f<number>: int, bytes, str or a list of them."""
    out = b""
    for name, values in fields.items():
        for v in values if isinstance(values, list) else [values]:
            number = int(name[1:])
            v = v.encode() if isinstance(v, str) else v
            out += varint(number << 3) + varint(v) if isinstance(v, int) else varint(number << 3 | 2) + varint(len(v)) + v
    return out


def tensor(name, dims, values):
    return message(f1=dims, f2=1, f8=name, f9=struct.pack(f"<{len(values)}f", *values))


def value(name, kind, dims):
    shape = message(f1=[message(f2=d) if isinstance(d, str) else message(f1=d) for d in dims])
    return message(f1=name, f2=message(f1=message(f1=kind, f2=shape)))


def tiny_model(path):
    """Logits are the mean over the tokens of their rows in a table: token k of 1 to 3 votes for class k, token 1 half for class 0 too."""
    table = [float(i == j) if i else 0.0 for i in range(4) for j in range(4)]
    table[4] = 0.5
    gather = message(f1=["table", "input_ids"], f2="rows", f4="Gather")
    mean = message(f1="rows", f2="logits", f4="ReduceMean", f5=[message(f1="axes", f8=1, f20=7), message(f1="keepdims", f3=0, f20=2)])
    graph = message(f1=[gather, mean], f2="g", f5=tensor("table", [4, 4], table), f11=value("input_ids", 7, ["b", "t"]), f12=value("logits", 1, ["b", 4]))
    path.write_bytes(message(f1=8, f8=message(f1="", f2=13), f7=graph))


@pytest.fixture
def files(tmp_path):
    pytest.importorskip("onnxruntime")
    tokenizers = pytest.importorskip("tokenizers")
    tiny_model(tmp_path / "m.onnx")
    t = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[PAD]": 0, "a": 1, "b": 2, "c": 3}, unk_token="[PAD]"))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    t.save(str(tmp_path / "t.json"))
    return str(tmp_path / "m.onnx"), str(tmp_path / "t.json")


def test_transformer_contract(spark, files):
    model, tokenizer = files
    run = scoring.transformer(model, tokenizer, 4, "class", batch=2)()
    assert run(["a a b", "c", "b b a b", "b a", "c c c c a a a a a a"]) == [1, 3, 2, 1, 3]  # a tie goes to the first, tokens beyond the fourth aren't read
    assert scoring.transformer(model, tokenizer, None, "class")()(["c c c c a a a a a a"]) == [1]
    assert scoring.transformer(model, tokenizer, 4, "logit")()(["a", "x a"]) == [0.25, 0.25]


def test_manifest(spark, files, tmp_path):
    model, tokenizer = files
    manifest = {
        "WebOrganizer/TopicClassifier": {"kind": "transformers", "path": model, "tokenizer": tokenizer},
        "HuggingFaceTB/fineweb-edu-classifier": {"kind": "transformers", "path": model, "tokenizer": tokenizer},
        "core42/jais-13b": {"kind": "tokenizer", "path": tokenizer},
        "WebOrganizer/FormatClassifier": {"kind": "transformers"},
    }
    (tmp_path / "models.json").write_text(json.dumps(manifest))
    from siltstone.plans.runtime import models

    registry = scoring.from_manifest(models(str(tmp_path / "models.json")))
    df = spark.createDataFrame([(1, "c c a", "b b b b b b"), (2, "b", None), (3, None, "c"), (4, "", None)], "id int, text string, url string")
    meter = Meter(spark, list(registry.outputs))
    out = scoring.score(df, registry, "text", "url", list(scoring.CONTRACTS), meter)
    rows = {r["id"]: r for r in out.collect()}
    assert dict(out.dtypes)["FormatClassifier"] == "bigint" and dict(out.dtypes)["fineweb_edu_classifier_score"] == "float"
    assert [rows[i]["TopicClassifier"] for i in (1, 2, 3)] == [2, 2, None]  # the prompt begins with the URL
    assert [rows[i]["jais_token_count"] for i in (1, 2, 3, 4)] == [4, 2, None, 1]
    assert all(r["FormatClassifier"] is None and r["fasttext_eli5_score"] is None for r in rows.values())
    assert meter.report()["TopicClassifier"]["calls"] >= 1
    for bad in ({"x/Other": {"kind": "tokenizer", "path": "p"}}, {"core42/jais-13b": {"kind": "other", "path": "p"}}):
        with pytest.raises(ValueError):
            scoring.from_manifest(bad)


def test_columns_of_models():
    assert scoring.column_of("WebOrganizer/FormatClassifier") == "FormatClassifier"
    assert scoring.column_of("core42/jais-13b") == "jais_token_count"


def test_empty_table(spark, files):
    registry = scoring.from_manifest({"core42/jais-13b": {"kind": "tokenizer", "path": files[1]}})
    assert scoring.score(spark.createDataFrame([], "text string"), registry).count() == 0
