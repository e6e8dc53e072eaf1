import pytest

from siltstone.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    df.write.format("noop").mode("overwrite").save()


COLUMNS = {
    "p2_found": [("record_id", "bigint"), ("topic_id", "bigint")],
    "p3_found": [("record_id", "bigint")],
    "p4_found": [("list_id", "bigint"), ("record_id", "bigint")],
    "p5_found": [("target_id", "int"), ("record_id", "bigint")],
    "p6_found": [("record_id", "bigint"), ("lang", "string")],
    "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p8_found": [("mix_id", "int"), ("source", "string")],
    "p9_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    assert df.dtypes == COLUMNS[name]
    rows = df.collect() if name != "p7_ids" else []
    assert len(rows) == len(set(rows))
