"""Queries on single records: flattening, prompts, selectors, shortening, adapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records, selector
from ..operators import adapters, scoring
from ..sources import jsonl, parquet


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, json): each order as a nested record with its lines as messages."""
    lines = _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("conv_id"), "l_linenumber", "l_partkey", "l_suppkey", F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("content")
    )
    turn = F.struct("l_linenumber", "l_partkey", "l_suppkey", "content")
    grouped = lines.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    message = F.transform("t", lambda t: F.struct(F.concat(F.lit("part "), t["l_partkey"].cast("string")).alias("role"), t["content"].alias("content")))
    meta = F.struct(F.concat(F.lit("https://x.example/"), F.col("conv_id").cast("string")).alias("url"), F.size("t").alias("turns"), F.lit(None).cast("string").alias("note"))
    return grouped.select("conv_id", message.alias("messages"), meta.alias("meta"))


def _json(spark: SparkSession, folder: str) -> DataFrame:
    nested = _conversations(spark, folder)
    return nested.select("conv_id", F.to_json(F.struct("meta", "messages"), {"ignoreNullFields": "false"}).alias("json"))


_TURNS = """SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag || ' ' || l_linestatus) - 1 AS i,
  'part ' || l_partkey AS role, l_returnflag || ' ' || l_linestatus AS content FROM lineitem"""


def flatten_props(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their properties opened one level, the schema found in the data."""
    events = _table(spark, folder, "events").withColumnRenamed("props", "line")
    schema = jsonl.infer(events.select("line"))
    nested = events.select("event_id", F.from_json("line", schema, {"mode": "FAILFAST"}).alias("props"))
    flat = records.flatten(nested)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


def topic_prompt(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "classify")
    return rows.select("row_id", records.prompt(F.col("text"), F.col("`meta.url`")).alias("prompt"))


def first_message_text(spark: SparkSession, folder: str) -> DataFrame:
    return _conversations(spark, folder).select("conv_id", records.first_message(F.col("messages")).alias("text"))


def clean_for_linear_model(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", records.one_line(F.col("text")).alias("text"))


def argmax_logits(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "embeddings").select("vec_id", scoring.class_of(F.col("embedding")).alias("class_id"))


def adapter_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The adapter that each source file's path names, the collections spelled as folders."""
    names = F.array(*[F.lit(n) for n in ("HPLT-3", "s2orc", "MegaMath-web", "Phil-Papers", "uspto", "other")])
    rows = _table(spark, folder, "classify").select("row_id", "source_file")
    path = F.concat(F.lit("/data/"), names[F.pmod("row_id", F.lit(6)).cast("int")], F.lit("/"), "source_file")
    return rows.select("row_id", adapters.choice(path).alias("adapter"))


def selector_key(spark: SparkSession, folder: str) -> DataFrame:
    return selector.select(_json(spark, folder), "json", "meta.url")


def selector_index(spark: SparkSession, folder: str) -> DataFrame:
    return selector.select(_json(spark, folder), "json", "messages[1].role")


def selector_wildcard(spark: SparkSession, folder: str) -> DataFrame:
    return selector.select(_json(spark, folder), "json", "messages.[].content")


def selector_quoted(spark: SparkSession, folder: str) -> DataFrame:
    return selector.select(_json(spark, folder), "json", """meta["turns"]""")


def selector_null(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON null is a match."""
    return selector.select(_json(spark, folder), "json", "meta.note")


def leaf_walk(spark: SparkSession, folder: str) -> DataFrame:
    return selector.walk(_json(spark, folder), "conv_id", "json")


def truncate_text(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", records.truncate_text(F.col("text")).alias("text"))


def truncate_list(spark: SparkSession, folder: str) -> DataFrame:
    head, note = records.truncate_list(F.col("embedding"))
    return _table(spark, folder, "embeddings").select("vec_id", F.size(head).alias("shown"), note.alias("note"))


def record_decoration(spark: SparkSession, folder: str) -> DataFrame:
    rows = parquet.with_row_number(_table(spark, folder, "classify")).select("row_id", "text", F.lit("older").alias("filename"), "line_number")
    return records.decorate(rows, "classify.parquet", F.col("line_number"))


def jsonl_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a JSON line, with its texts, nulls and numbers."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars", "title")
    return docs.select("doc_id", records.json_line(docs).alias("line"))


def jsonl_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Events' property lines through the strict reader."""
    events = _table(spark, folder, "events").select("event_id", F.col("props").alias("line"))
    return jsonl.strict(events).select("event_id", F.variant_get("record", "$.k", "bigint").alias("k"))


def jsonl_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """How many delivered lines of each feed are JSON objects."""
    lines = jsonl.lenient(_table(spark, folder, "raw_lines").select("feed", "line"))
    return lines.groupBy("feed").agg(F.count("*").alias("n"))


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    """Delivered objects, all typed values of which vary from line to line."""
    return jsonl.lenient(_table(spark, folder, "raw_lines").select("feed", "file_no", "line_no", "line")).drop("record")


def _adapted(name: str, more: tuple[str, ...] = ()):
    adapter = next(a for a in adapters.ADAPTERS if a.name == name)

    def query(spark: SparkSession, folder: str) -> DataFrame:
        out = adapters.apply(_raw(spark, folder), adapter, more=more)
        return out.toDF(*[c.replace(".", "_").replace("-", "_") for c in out.columns])

    query.__name__ = f"adapter_{name}"
    query.__doc__ = f"Delivered lines under the {name} adapter's types."
    return query


def adapter_structs(spark: SparkSession, folder: str) -> DataFrame:
    """Records with planted objects, some of the wrong shape, under the adapters that type objects."""
    rows = _table(spark, folder, "classify").select("row_id", "subset")
    quoted = F.when(F.col("subset").isNull(), "null").otherwise(F.concat(F.lit('"'), "subset", F.lit('"')))
    number = F.col("row_id").cast("string")
    pick = lambda part, yes, no: F.when(F.col("row_id") % part == 0, yes).otherwise(no)
    hplt = F.concat(
        F.lit('{"text": "t", "meta": {"hplt_attr": {"c": '), pick(5, F.lit("7"), quoted), F.lit(', "o": '), pick(3, F.lit('"x"'), number),
        F.lit(', "doc_scores": ['), (F.col("row_id") % 7).cast("string"), F.lit(', "x", null], "pii": '), pick(4, F.concat(F.lit("[["), number, F.lit("]]")), F.concat(F.lit("[[["), number, F.lit("]]]"))),
        F.lit(', "seg_langs": ["en", 2]}}}'),
    )
    s2orc = F.concat(F.lit('{"meta": {"openaccessinfo": {"externalids": {"DOI": '), pick(2, number, F.concat(F.lit('"doi-'), number, F.lit('"'))), F.lit('}, "status": '), pick(6, F.lit("[1]"), F.lit('"open"')), F.lit("}}}"))
    web = F.concat(F.lit('{"meta": {"dup_signals": {"dup_doc_count": '), pick(3, F.concat(F.lit('"'), number, F.lit('"')), number), F.lit('}, "media": '), pick(3, F.concat(F.lit("["), (F.col("row_id") % 11).cast("string"), F.lit(', "x"]')), F.lit('{"no": 1}')), F.lit("}}"))
    one = lambda line, adapter: adapters.apply(rows.select("row_id", line.alias("line")), adapter)
    a = one(hplt, adapters.HPLT).select("row_id", *[F.col("`meta.hplt_attr`")[c].alias(c) for c in ("c", "o", "doc_scores", "seg_langs")], F.col("`meta.hplt_attr`")["pii"][0][0][0].cast("string").alias("pii"))
    b = one(s2orc, adapters.S2ORC).select("row_id", F.col("`meta.openaccessinfo`")["externalids"]["DOI"].alias("doi"), F.col("`meta.openaccessinfo`")["status"].alias("status"))
    c = one(web, adapters.MEGAMATH).select("row_id", F.col("`meta.dup_signals`")["dup_doc_count"].alias("dup_megamath"), F.col("`meta.media`").alias("media"))
    d = one(web, adapters.USPTO).select("row_id", F.col("`meta.dup_signals`")["dup_doc_count"].alias("dup_uspto"))
    return a.join(b, "row_id").join(c, "row_id").join(d, "row_id")


def lexical_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The annotation columns by stand-in scorers."""
    rows = _table(spark, folder, "classify").select("row_id", "text", F.col("`meta.url`").alias("url"))
    return scoring.score(rows, scoring.lexical(), "text", "url").drop("text", "url")


QUERIES = {
    f.__name__: f
    for f in (
        flatten_props, topic_prompt, first_message_text, clean_for_linear_model, argmax_logits, adapter_choice, selector_key, selector_index,
        selector_wildcard, selector_quoted, selector_null, leaf_walk, truncate_text, truncate_list, record_decoration, jsonl_rows, jsonl_strict,
        jsonl_lenient, _adapted("hplt"), _adapted("s2orc"), _adapted("megamath"), _adapted("philpapers"), _adapted("uspto", ("meta.url", "meta.title")), adapter_structs, lexical_scores,
    )
}

def _portion(signs: str, top: float) -> str:
    return f"CAST((length(text) - length(translate(text, '{signs}', ''))) * {top}::DOUBLE / (1 + length(text)) AS FLOAT)"


_LEXICAL = f"""SELECT row_id, CAST(length(p) % {scoring.CLASSES} AS BIGINT) AS TopicClassifier, CAST(length(replace(p, chr(10), '')) % {scoring.CLASSES} AS BIGINT) AS FormatClassifier,
  {_portion('bcdfgmpvw', 9.0)} AS fineweb_edu_classifier_score, CAST(length(text) // 4 + 1 AS BIGINT) AS jais_token_count,
  {_portion('aeiou', 1.0)} AS fasttext_eli5_score, {_portion('nrstl', 1.0)} AS fasttext_preselect_score
  FROM (SELECT row_id, text, coalesce("meta.url", '') || chr(10) || chr(10) || text AS p FROM classify)"""

# What the adapters make of the objects that adapter_structs plants, from the columns that they are made of.
_STRUCTS = """SELECT row_id, CASE WHEN row_id % 5 != 0 THEN subset END AS c, CASE WHEN row_id % 3 != 0 THEN row_id END AS o,
  [CAST(row_id % 7 AS DOUBLE), NULL, NULL] AS doc_scores, CASE WHEN row_id % 4 != 0 THEN CAST(row_id AS VARCHAR) END AS pii, ['en', NULL] AS seg_langs,
  CASE WHEN row_id % 2 = 0 THEN CAST(row_id AS VARCHAR) ELSE 'doi-' || row_id END AS doi, CASE WHEN row_id % 6 != 0 THEN 'open' END AS status,
  CASE WHEN row_id % 3 != 0 THEN row_id END AS dup_megamath, CASE WHEN row_id % 3 = 0 THEN [CAST(row_id % 11 AS INT), NULL] ELSE NULL END AS media, row_id AS dup_uspto
  FROM classify"""

_LINES = r"""CASE WHEN text = '' THEN []::VARCHAR[] ELSE list_transform([1], lambda q: CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END)[1] END"""

ORACLE_SQL = {
    "flatten_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events",
    "topic_prompt": """SELECT row_id, coalesce("meta.url", '') || chr(10) || chr(10) || text AS prompt FROM classify""",
    "first_message_text": f"SELECT conv_id, content AS text FROM ({_TURNS}) WHERE i = 0",
    "clean_for_linear_model": "SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM documents",
    "argmax_logits": "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS class_id FROM embeddings",
    "adapter_choice": """SELECT row_id, CASE row_id % 6 WHEN 0 THEN 'hplt' WHEN 1 THEN 's2orc' WHEN 2 THEN 'megamath' WHEN 3 THEN 'philpapers' WHEN 4 THEN 'uspto' END AS adapter
        FROM classify""",
    "selector_key": "SELECT DISTINCT l_orderkey AS conv_id, 'meta.url' AS path, '\"https://x.example/' || l_orderkey || '\"' AS value FROM lineitem",
    "selector_index": f"SELECT conv_id, 'messages.[1].role' AS path, '\"' || role || '\"' AS value FROM ({_TURNS}) WHERE i = 1",
    "selector_wildcard": f"SELECT conv_id, 'messages.[' || i || '].content' AS path, '\"' || content || '\"' AS value FROM ({_TURNS})",
    "selector_quoted": "SELECT l_orderkey AS conv_id, 'meta.turns' AS path, CAST(count(*) AS VARCHAR) AS value FROM lineitem GROUP BY 1",
    "selector_null": "SELECT DISTINCT l_orderkey AS conv_id, 'meta.note' AS path, 'null' AS value FROM lineitem",
    "leaf_walk": f"""WITH t AS ({_TURNS}), o AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1)
        SELECT conv_id, 0::INT AS ordinal, 'meta.url' AS path, '"https://x.example/' || conv_id || '"' AS value FROM o
        UNION ALL SELECT conv_id, 1, 'meta.turns', CAST(n AS VARCHAR) FROM o
        UNION ALL SELECT conv_id, 2, 'meta.note', 'null' FROM o
        UNION ALL SELECT conv_id, (3 + 2 * i)::INT, 'messages.[' || i || '].role', '"' || role || '"' FROM t
        UNION ALL SELECT conv_id, (4 + 2 * i)::INT, 'messages.[' || i || '].content', '"' || content || '"' FROM t""",
    "truncate_text": f"""SELECT doc_id, CASE WHEN text IS NULL OR (length(text) <= 4000 AND len(l) <= 12) THEN text
          ELSE substr(array_to_string(l[:12], chr(10)), 1, 4000) || chr(10) || chr(10) || '… [truncated: ' || len(l) || ' lines, ' || length(text)
               || ' chars; showing up to 12 lines / 4000 chars]' END AS text
        FROM (SELECT doc_id, text, {_LINES} AS l FROM (SELECT doc_id, text,
          regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS p FROM documents))""",
    "truncate_list": """SELECT vec_id, least(len(embedding), 6)::INT AS shown, CASE WHEN len(embedding) > 6 THEN
        '… [truncated array: ' || len(embedding) || ' items; showing first 6, omitted ' || (len(embedding) - 6) || ']' END AS note FROM embeddings""",
    "record_decoration": "SELECT row_id, text, 'classify.parquet' AS filename, row_number() OVER () - 1 AS line_number FROM classify",
    "jsonl_rows": "SELECT doc_id, CAST(to_json(struct_pack(doc_id, text, lang, n_chars, title)) AS VARCHAR) AS line FROM documents",
    "lexical_scores": _LEXICAL,
    "adapter_structs": _STRUCTS,
    "jsonl_strict": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "jsonl_lenient": "SELECT feed, count(*) AS n FROM raw_lines WHERE json_valid(line) AND ltrim(line) LIKE '{%' GROUP BY 1",
}


def _adapter_sql(name: str, more: tuple[str, ...] = ()) -> str:
    """The adapter's scalar rules over delivered lines, meta nested or flattened."""
    adapter = next(a for a in adapters.ADAPTERS if a.name == name)
    cells = ["feed", "file_no", "line_no"]
    strict = {"text", "subset"} - set(adapter.columns)
    for column in [*strict, *adapter.columns, *[c for c in more if c not in adapter.columns]]:
        kind = "string" if column in strict else (adapter.rule(column) or ("string",))[0]
        top = f"json_extract(line, '$.\"{column}\"')"
        nested = f"json_extract(line, '$.meta.\"{column.removeprefix('meta.')}\"')" if column.startswith("meta.") else "NULL"
        value = f"coalesce({nested}, {top})"
        text, shape = f"json_extract_string({value}, '$')", f"json_type({value})"
        if adapter.rest is not None and kind == "bigint":
            cell = f"CASE WHEN {shape} IN ('BIGINT', 'UBIGINT') OR ({shape} = 'DOUBLE' AND CAST({text} AS DOUBLE) = floor(CAST({text} AS DOUBLE))) THEN CAST(CAST({text} AS DOUBLE) AS BIGINT) WHEN {shape} = 'VARCHAR' THEN try_cast(trim({text}) AS BIGINT) END"
        elif adapter.rest is not None and kind == "string":
            joined = f"array_to_string(list_transform(CAST({value} AS JSON[]), lambda x: coalesce(json_extract_string(x, '$'), '')), ' | ')"
            cell = f"CASE {shape} WHEN 'ARRAY' THEN {joined} WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN upper(left({text}, 1)) || substr({text}, 2) ELSE {text} END"
        elif column in strict:
            cell = f"CASE WHEN {shape} = 'VARCHAR' THEN {text} END"
        elif kind == "double":
            cell = f"CASE WHEN {shape} IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST({text} AS DOUBLE) END"
        elif kind == "bigint":
            cell = f"CASE WHEN {shape} IN ('BIGINT', 'UBIGINT') THEN CAST({text} AS BIGINT) END"
        elif kind == "string":
            cell = f"CASE {shape} WHEN 'VARCHAR' THEN {text} WHEN 'BOOLEAN' THEN upper(left({text}, 1)) || substr({text}, 2) WHEN 'DOUBLE' THEN {text} WHEN 'BIGINT' THEN {text} WHEN 'UBIGINT' THEN {text} END"
        else:
            cell = "NULL"  # no delivered line has such an object; adapter_structs plants some
        cells.append(f'{cell} AS "{column.replace(".", "_").replace("-", "_")}"')
    return f"SELECT {', '.join(cells)} FROM raw_lines WHERE json_valid(line) AND ltrim(line) LIKE '{{%'"


ORACLE_SQL |= {f"adapter_{n}": _adapter_sql(n) for n in ("hplt", "s2orc", "megamath", "philpapers")}
ORACLE_SQL["adapter_uspto"] = _adapter_sql("uspto", ("meta.url", "meta.title"))
