"""Texts whose end is missing, found by word trigrams in pure SQL.

A word is terminal if a sentence mark, a line end or the text's end follows, and
inner if more of its sentence does.  Over the distinct texts of the corpus, so
that copies weigh once, each trigram's terminal and inner occurrences are
counted.  A final trigram that is often inner
but almost never terminal shows that its text stops where sentences go on.  Too
rare a trigram is judged by its last two words, its last word, or what follows
its first two elsewhere.  A text cut inside a word ends in a string that is
unknown there but begins a word that follows the same two words elsewhere.

Marks that a cutting system leaves (an ellipsis with or without "read more", an
open comment, half an entity or character) and white space at the end are taken
off before the final trigram is read, and are evidence of their own: they also
stand behind texts that were cut right before a full stop, where any trigram
looks whole.  Three full stops also end whole texts; they need a final trigram
that is known and doesn't usually stop.

Texts that end in a full stop or another sentence mark, and null, empty and
blank ones, are no cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..plans.lineage import materialize

MIN_INNER = 3  # a trigram must be inner so often
MAX_TERMINAL = 0.05  # ... and terminal in at most this part of its occurrences
MIN_PAIR, MIN_WORD = 10, 20  # occurrences of the last two words, of the last word, that judge a rare trigram
MAX_TERMINAL_RARE = 0.02  # ... and the part of them that may be terminal

# What cutting systems put at the end.
HARD_MARKS = r"((?<!\s)\s*+(\.\.\.|…)?\s*+([\[(]\s*+(read more|more|continue reading|truncated)\s*+[\])]|(?<=(\.\.\.|…)\s?)(read more|more|continue reading))|…|\x{FFFD}+|(?-i:&(#[0-9x]{0,6}|[a-z]{0,7})))$"
SOFT_MARK = r"\.\.\.\s*$"
BLANKS = " \t\n\x0b\f\r\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Marks but comments have at most MARK_SIGNS signs that aren't blank; if the last MARK_CHARS hold more, a mark lies within them.
MARK_SIGNS, MARK_CHARS = 22, 64
BITS = 1 << 22  # of the array that the keys' parts are hashed to
COPY_BITS = 1 << 24  # ... and of the one for ids of texts with copies; more keys and copies only let more rows through
LISTED_COPIES = 200_000
LAST_CHARS = 100  # if so many last characters hold more than three tokens, the last three are the whole text's
# Words (numbers of equally many digits are one), signs inside sentences, list signs, sentence marks, line ends.
TOKENS = r"[\p{L}\p{M}\p{N}]++|[,;]|[-–—*•>|→]+(?=\s|$)|[.](?=[\s\"”’)\]]|$)|\n(?!\n)"
# Signs that count as one, by place in the two strings.
LINE = "\n"
FROM, TO = "123456789!?…\r", "000000000...\n"


def verdicts(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, marked, cut, evidence) of each row whose text holds a letter or digit; evidence is
    trigram where the trigrams show the cut, and mark where only a mark does."""
    spark = documents.sparkSession
    sql = spark.sql
    docs = documents.select(F.col(key).alias("_key"), F.col(source).alias("source"), F.col(text).alias("text"))
    tokens = {"tokens": TOKENS, "from": FROM, "to": TO}
    words = lambda text: f"regexp_extract_all(translate(lower({text}), :from, :to), :tokens, 0)"
    # A comment after the last ">" but its own is a mark; it may be of any length.
    trimmed = sql(
        """
        SELECT _key, source, open > 0 AS comment, if(open > 0, trim(TRAILING :blanks FROM left(text, length(whole) - length(after) + open - 1)), text) AS text
        FROM (SELECT *, locate('<!--', after) AS open
              FROM (SELECT *, substring_index(whole, '>', -1) AS after
                    FROM (SELECT *, if(endswith(text, '-->'), left(text, length(text) - 3), text) AS whole
                          FROM (SELECT _key, source, if(locate(right(text, 1), :blanks) > 0, trim(TRAILING :blanks FROM text), text) AS text FROM {docs} WHERE text RLIKE :wordy))))
        """,
        {"blanks": BLANKS, "wordy": r"[\p{L}\p{N}]"},
        docs=docs,
    )
    bodies = sql(
        """
        SELECT _key, source, comment OR length(plain) < length(tail) AS hard, length(bare) < length(plain) AS soft,
               concat(left(text, length(text) - length(tail)), bare) AS body
        FROM (SELECT *, regexp_replace(plain, :soft, '') AS bare
              FROM (SELECT *, if(comment, tail, regexp_replace(tail, :hard, '')) AS plain
                    FROM (SELECT *, if(length(translate(right(text, :chars), :blanks, '')) > :signs OR length(text) <= :chars,
                                       right(text, :chars), regexp_extract(text, :last, 0)) AS tail
                          FROM {trimmed})))
        """,
        {"hard": "(?i)" + HARD_MARKS, "soft": SOFT_MARK, "chars": MARK_CHARS, "signs": MARK_SIGNS, "blanks": BLANKS, "last": rf"(?:\S\s*+){{0,{MARK_SIGNS + 1}}}$"},
        trimmed=trimmed,
    )
    final = sql(
        f"""
        SELECT _key, source, hard, soft, md5(body) AS id,
               if(size(w) > 2, w[size(w) - 3], :line) AS a, if(size(w) > 1, w[size(w) - 2], :line) AS b,
               if(size(w) > 0, w[size(w) - 1], '.') AS c
        FROM (SELECT _key, source, hard, soft, body, if(size(w) > 3 OR length(body) <= {LAST_CHARS}, w, {words('body')}) AS w
              FROM (SELECT *, {words(f'right(body, {LAST_CHARS})')} AS w FROM {{bodies}}))
        """,
        tokens | {"line": LINE},
        bodies=bodies,
    )
    final = materialize(final, "final")
    keys = materialize(sql("SELECT DISTINCT a, b, c FROM {final} WHERE c NOT IN ('.', :line)", {"line": LINE}, final=final), "keys")
    trigrams, marks = _counted(sql(f"SELECT {words('body')} AS w FROM {{once}}", tokens, once=_once(bodies, final)), keys)
    begun = sql(  # longer words after the same two words, by their beginnings as long as a final word
        """
        SELECT a, b, p AS c, sum(n) AS n, sum(n - ends) AS inner_n
        FROM (SELECT t.a, t.b, t.n, t.ends, explode(transform(filter(k.sizes, s -> s < length(t.c)), s -> left(t.c, s))) AS p
              FROM {trigrams} t JOIN (SELECT a, b, collect_set(length(c)) AS sizes FROM {keys} GROUP BY a, b) k ON t.a = k.a AND t.b = k.b)
        GROUP BY 1, 2, 3
        """,
        trigrams=trigrams, keys=keys,
    )
    # A last word or pair may be that of a third of all keys.
    spread = keys
    for kind, name, by, rest in (("2", "pair", ["b", "c"], ["a"]), ("3", "word", ["c"], ["a", "b"]), ("1", "after", ["a", "b"], ["c"])):
        needed = _hit(kind, *by) + ("" if name == "word" else " AND a IS NOT NULL")
        sums = sql(f"SELECT {', '.join(by)}, sum(n) AS {name}_n, sum(ends) AS {name}_ends FROM {{trigrams}} WHERE {needed} GROUP BY ALL", trigrams=trigrams, marks=marks)
        spread = spread_join(spread, sums, by, by=rest)
    # The final occurrence of a text itself, one for all its copies, counts as terminal and is taken off again.
    judged = sql(
        rf"""
        WITH known AS (
          SELECT k.a, k.b, k.c, t.n - 1 AS n, t.ends - 1 AS ends, pair_n - 1 AS pair_n, pair_ends - 1 AS pair_ends,
                 word_n - 1 AS word_n, word_ends - 1 AS word_ends, after_n - 1 AS after_n, after_ends - 1 AS after_ends,
                 coalesce(g.n, 0) AS begun_n, coalesce(g.inner_n, 0) AS begun_inner
          FROM {{spread}} k
          JOIN {{trigrams}} t ON k.a = t.a AND k.b = t.b AND k.c = t.c
          LEFT JOIN {{begun}} g ON k.a = g.a AND k.b = g.b AND k.c = g.c
        )
        SELECT a, b, c,
               n - ends >= {MIN_INNER} AND ends <= {MAX_TERMINAL} * n AS goes_on,
               n - ends <= 0.01 * begun_n AND ends <= 0.1 * begun_n AND begun_n >= 2
                 AND (begun_inner >= 1 OR word_ends <= {MAX_TERMINAL} * word_n) AS half_word,
               n < {MIN_INNER} AND b != :line AND (
                 CASE WHEN pair_n >= {MIN_PAIR} THEN pair_ends <= {MAX_TERMINAL_RARE} * pair_n AND word_ends <= {MAX_TERMINAL} * word_n
                      WHEN word_n >= {MIN_WORD} AND word_ends <= 0.01 * word_n THEN true
                      ELSE a RLIKE r'^\p{{{{L}}}}' AND b RLIKE r'^\p{{{{L}}}}'
                           AND after_n >= {MIN_WORD} AND after_ends <= 0.01 * after_n AND word_ends <= 0.5 * word_n END
               ) AS rare_goes_on,
               n >= 2 AND ends >= 0.5 * n AS stops
        FROM known
        """,
        {"line": LINE},
        spread=spread, trigrams=trigrams, begun=begun,
    )
    found = sql("SELECT a, b, c, goes_on OR half_word OR rare_goes_on AS goes_on, stops FROM {judged} WHERE goes_on OR half_word OR rare_goes_on OR NOT stops", judged=judged)
    # Many texts may end alike.
    out = spread_join(final, found, ["a", "b", "c"], by=["_key", "id"], how="left")
    return out.select(
        F.col("_key").alias(key), "source", F.expr("hard OR soft").alias("marked"),
        F.expr("coalesce(goes_on, false) OR hard OR (soft AND NOT coalesce(stops, true))").alias("cut"),
        F.expr("CASE WHEN goes_on OR (soft AND NOT hard AND NOT stops) THEN 'trigram' WHEN hard THEN 'mark' END").alias("evidence"),
    )


def _bits(hashes: DataFrame, bits: int, name: str) -> DataFrame:
    """One row with ``bits``: an array of 64-bit numbers in which the bits of the hashes (column h) are set."""
    sql = hashes.sparkSession.sql
    return materialize(sql(
        f"""
        SELECT transform(array_sort(collect_list(struct(r.id AS i, coalesce(w.bits, 0) AS bits))), x -> x.bits) AS bits
        FROM range({bits // 64}) r LEFT JOIN (
          SELECT shiftright(h, 6) AS i, bit_or(shiftleft(1L, CAST(h & 63 AS INT))) AS bits
          FROM (SELECT pmod(h, {bits}) AS h FROM {{hashes}}) GROUP BY 1) w ON r.id = w.i
        """,
        hashes=hashes,
    ), name)


def _set(bits: int, *parts: str) -> str:
    """SQL: whether the bit of the hash of some values is set in {marks}."""
    h = f"xxhash64({', '.join(parts)})"
    return f"getbit((SELECT bits FROM {{marks}})[shiftright(pmod({h}, {bits}), 6)], pmod({h}, 64)) = 1"


def _hit(*parts: str) -> str:
    return _set(BITS, *parts)


def _once(bodies: DataFrame, final: DataFrame, listed: int = LISTED_COPIES) -> DataFrame:
    """(body), each once.

    Up to `listed` further copies are left out by a broadcast list of their keys.  With
    more, or where copies share a key, the bodies whose id is that of copies, or has
    a bit in common with one, are shuffled, and no others.  The results are the same.
    """
    sql = bodies.sparkSession.sql
    copied = materialize(sql("SELECT id, min(_key) AS first, count(*) AS n, count(DISTINCT _key) AS keys FROM {final} GROUP BY id HAVING count(*) > 1", final=final), "copied")
    # The generator keeps filters and joins from being moved below, where they would compute the bodies twice.
    rows = sql("SELECT inline(array(struct(_key, md5(body) AS id, body))) FROM {bodies}", bodies=bodies)
    more, shared = copied.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)), F.count_if(F.expr("n != keys"))).first()
    if more <= listed and not shared:
        rest = sql("SELECT f._key, f.id FROM {final} f JOIN {copied} c ON f.id = c.id WHERE f._key != c.first", final=final, copied=copied)
        rest = F.broadcast(materialize(rest, "rest"))  # at most `listed` rows
        return sql("SELECT body FROM {rows} r LEFT ANTI JOIN {rest} c ON r._key = c._key AND r.id = c.id", rows=rows, rest=rest)
    marks = _bits(sql("SELECT xxhash64(id) AS h FROM {copied}", copied=copied), COPY_BITS, "copies")
    alone = sql(f"SELECT body FROM {{rows}} WHERE NOT {_set(COPY_BITS, 'id')}", rows=rows, marks=marks)
    again = sql(f"SELECT id, body FROM {{rows}} WHERE {_set(COPY_BITS, 'id')}", rows=rows, marks=marks)
    return alone.union(again.dropDuplicates(["id"]).select("body"))


def _counted(texts: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, c, n, ends) and the bit array: how often trigrams occur in the texts (w), and how often
    at ends, as far as the keys need it: trigrams that share the first or the last two words with a
    key, and with null a and b the other occurrences of the keys' last words.

    What no key can need is dropped before the shuffle by an array of BITS bits;
    trigrams that pass it by chance match no key later.
    """
    sql = texts.sparkSession.sql
    marks = _bits(sql("SELECT explode(array(xxhash64(1, a, b), xxhash64(2, b, c), xxhash64(3, c))) AS h FROM {keys}", keys=keys), BITS, "marks")
    rows = sql(
        """
        SELECT inline(arrays_zip(a, b, c, next)) AS (a, b, c, next)
        FROM (SELECT slice(concat(array(:line, :line), w), 1, size(w)) AS a, slice(concat(array(:line), w), 1, size(w)) AS b, w AS c,
                     concat(slice(w, 2, greatest(size(w) - 1, 0)), array('')) AS next
              FROM {texts})
        """,
        {"line": LINE},
        texts=texts,
    )
    sums = sql(
        f"""
        SELECT if(near, a, NULL) AS a, if(near, b, NULL) AS b, c, count(*) AS n, count_if(next IN ('', '.', :line)) AS ends
        FROM (SELECT *, {_hit('1', 'a', 'b')} OR {_hit('2', 'b', 'c')} AS near FROM {{rows}} WHERE c NOT IN ('.', :line))
        WHERE near OR {_hit('3', 'c')}
        GROUP BY 1, 2, 3
        """,
        {"line": LINE},
        rows=rows, marks=marks,
    )
    return materialize(sums, "trigrams"), marks


def rates(found: DataFrame) -> DataFrame:
    """(source, texts, cut, by_mark, share) per source, by_mark being those that only a mark shows; a null source is a group of its own."""
    return found.groupBy("source").agg(
        F.count("*").alias("texts"), F.count_if("cut").alias("cut"), F.count_if(F.col("evidence") == "mark").alias("by_mark"),
        (F.count_if("cut") / F.count("*")).alias("share"),
    )
