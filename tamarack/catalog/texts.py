"""Scalar text, date, lexicon and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.profiles import FLAG_SQL, LETTERS, SENTENCES, TOKENS
from tamarack.catalog.registry import TEST_KEYWORDS, Tables, big, query, rounded
from tamarack.functions.constants import ENTITY_TYPES
from tamarack.functions.dates import day_name, days_between, with_date_parts
from tamarack.functions.text import (
    exploded_terms,
    whitespace_word_count,
    with_keyword_flags,
    with_readability,
    with_token_stats,
)
from tamarack.operators.lexicon import with_entity_counts, with_sentiment
from tamarack.operators.selection import percentile_rank
from tamarack.operators.splitting import with_split
from tamarack.operators.vectors import TRIGRAMS, vocabulary
from tamarack.session import spread


@query(
    "date_parts",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(month(o_orderdate) AS BIGINT) AS order_month,
      CAST(day(o_orderdate) AS BIGINT) AS order_day FROM orders
    """,
)
def date_parts(t: Tables) -> DataFrame:
    parts = with_date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "order")
    return parts.select("o_orderkey", *[big(f"order_{p}").alias(f"order_{p}") for p in ("year", "month", "day")])


@query("day_names", "SELECT event_id, dayname(ts) AS day_of_week FROM events")
def day_names(t: Tables) -> DataFrame:
    return t.events.select("event_id", day_name("ts").alias("day_of_week"))


@query(
    "days_between",
    """
    SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def days_between_query(t: Tables) -> DataFrame:
    facts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    joined = facts.join(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
    days = big(days_between("l_shipdate", "o_orderdate")).alias("days")
    return joined.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", days)


@query("ws_word_count", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS words FROM documents")
def ws_word_count(t: Tables) -> DataFrame:
    return spread(t.documents.select("doc_id", "text"), "doc_id").select(
        "doc_id", big(whitespace_word_count("text")).alias("words")
    )


@query(
    "token_stats",
    rf"""
    SELECT doc_id, CAST({TOKENS} AS BIGINT) AS word_count, round({LETTERS} / {TOKENS}, 6) AS avg_word_length,
      CAST({SENTENCES} AS BIGINT) AS num_sentences FROM documents
    """,
)
def token_stats(t: Tables) -> DataFrame:
    out = with_token_stats(spread(t.documents.select("doc_id", "text"), "doc_id"), "text")
    return out.select(
        "doc_id", big("word_count").alias("word_count"), F.round("avg_word_length", 6).alias("avg_word_length"),
        big("num_sentences").alias("num_sentences"),
    )


@query("keyword_flags", f"SELECT doc_id, {FLAG_SQL} FROM documents")
def keyword_flags(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"), "doc_id")
    return with_keyword_flags(texts, "text", TEST_KEYWORDS).drop("text")


@query(
    "readability",
    rf"""
    WITH d AS (SELECT doc_id, {SENTENCES} AS s, list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}'']+'),
        lambda w: greatest(1, len(regexp_extract_all(w, '[aeiouy]+')) - len(regexp_extract_all(w, '[^aeiouy]e$')))) AS y
      FROM documents),
    c AS (SELECT doc_id, s, len(y) AS w, list_sum(y) AS a, len(list_filter(y, lambda x: x >= 3)) AS p FROM d)
    SELECT doc_id,
      CASE WHEN w > 0 THEN round(206.835 - 1.015 * (w / s) - 84.6 * (a / w), 4) ELSE 0 END AS flesch_reading_ease,
      CASE WHEN w > 0 THEN round(0.39 * (w / s) + 11.8 * (a / w) - 15.59, 4) ELSE 0 END AS flesch_kincaid_grade,
      CASE WHEN s >= 3 THEN round(1.043 * sqrt(30.0 * p / s) + 3.1291, 4) ELSE 0 END AS smog_index
    FROM c
    """,
)
def readability(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"), "doc_id")
    out = with_readability(texts, "text").drop("text")
    return rounded(out, 4, "flesch_reading_ease", "flesch_kincaid_grade", "smog_index")


@query(
    "ngrams_1_3_top",
    r"""
    WITH w AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
    g AS (SELECT unnest(t) AS term FROM w
      UNION ALL SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM w
      UNION ALL SELECT unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM w)
    SELECT term, count(*) AS tf FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200
    """,
)
def ngrams_1_3_top(t: Tables) -> DataFrame:
    return vocabulary(t.documents, "text", 200, TRIGRAMS)


@query(
    "top15_tokens",
    r"""
    SELECT term, count(*) AS tf FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15
    """,
)
def top15_tokens(t: Tables) -> DataFrame:
    return vocabulary(t.documents, "text", 15)


@query(
    "length_percentile",
    rf"""
    WITH d AS (SELECT doc_id, source, {TOKENS} AS wc FROM documents)
    SELECT doc_id, round((rank() OVER (PARTITION BY source ORDER BY wc) + (count(*) OVER (PARTITION BY source, wc) - 1) / 2.0)
      / count(wc) OVER (PARTITION BY source), 6) AS pct FROM d
    """,
)
def length_percentile(t: Tables) -> DataFrame:
    sized = with_token_stats(spread(t.documents.select("doc_id", "source", "text"), "doc_id"), "text").drop("text")
    ranked = percentile_rank(sized, ["source"], "word_count", "pct", ["doc_id"])
    return ranked.select("doc_id", F.round("pct", 6).alias("pct"))


@query(
    "price_percentile",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, round((rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice)
      + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0)
      / count(l_extendedprice) OVER (PARTITION BY l_returnflag), 8) AS pct FROM lineitem
    """,
)
def price_percentile(t: Tables) -> DataFrame:
    """Three groups hold all rows here: ranks come from value ranges, not from one sort per group."""
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    ranked = percentile_rank(facts, ["l_returnflag"], "l_extendedprice", "pct", ["l_orderkey", "l_linenumber"])
    return rounded(ranked.drop("l_returnflag"), 8, "pct")


@query(
    "stratified_split_sizes",
    """
    WITH c AS (SELECT l_linenumber AS label, count(*) AS n FROM (SELECT o_orderkey % 7 AS l_linenumber FROM orders
                 UNION ALL SELECT 0 FROM documents) GROUP BY 1),
    q AS (SELECT label, n, n * z * 1.0 / s AS x, floor(n * z * 1.0 / s) AS f, z FROM c,
            (SELECT sum(n) AS s, ceil(sum(n) * 0.2) AS z FROM c)),
    r AS (SELECT *, row_number() OVER (ORDER BY x - f DESC, label) AS k, z - sum(f) OVER () AS spare FROM q)
    SELECT label, CAST(f + CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS test_rows,
      CAST(n - f - CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS train_rows FROM r
    """,
)
def stratified_split_sizes(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.pmod("o_orderkey", F.lit(7)).cast("bigint").alias("label"))
    texts = t.documents.select((-F.col("doc_id") - 1).alias("id"), F.lit(0).cast("bigint").alias("label"))
    split = with_split(orders.unionAll(texts), "label", "id")
    return split.groupBy("label").agg(
        F.count(F.when(F.col("split") == "test", 1)).alias("test_rows"),
        F.count(F.when(F.col("split") == "train", 1)).alias("train_rows"),
    )


# Modifier words of the sentiment test, all frequent in the test texts.
BOOSTERS, DAMPENERS, NEGATIONS = ["the", "der", "le"], ["is", "und", "la"], ["that", "die", "un"]


def word_valences(t: Tables) -> DataFrame:
    """Words of the benchmark texts with a valence derived from their letters."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), F.lit(0))
    words = exploded_terms(t.benchmark, [], found, "term")
    valence = (F.pmod(F.length("term") * 7 + F.ascii("term"), F.lit(9)) - 4).cast("double") / 2
    return words.distinct().withColumn("valence", valence)


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _sentiment_sql() -> str:
    edge = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"
    steps = []
    previous = "v0"
    for k, fade in zip((1, 2, 3), (1.0, 0.95, 0.9)):
        boost = f"CASE WHEN b{k} IN {_in(BOOSTERS)} THEN 0.293 WHEN b{k} IN {_in(DAMPENERS)} THEN -0.293 ELSE 0 END"
        turn = f"CASE WHEN b{k} IN {_in(NEGATIONS)} THEN -0.74 ELSE 1 END"
        steps.append(f"s{k} AS (SELECT *, ({previous} + sign({previous}) * ({boost}) * {fade}) * ({turn}) AS v{k} FROM s{k - 1})")
        previous = f"v{k}"
    return rf"""
    WITH lex AS (SELECT term, ((length(term) * 7 + ascii(term)) % 9 - 4) / 2.0 AS valence FROM (SELECT DISTINCT
        unnest(regexp_extract_all(lower(text), '[\p{{L}}]{{3,}}')) AS term FROM benchmark)),
    w AS (SELECT doc_id, text, list_transform(regexp_extract_all(text, '[^ \t\n\r\f]+'), lambda x: CASE WHEN
        length(regexp_replace(x, '{edge}', '', 'g')) <= 2 THEN x ELSE regexp_replace(x, '{edge}', '', 'g') END) AS t FROM documents),
    m AS (SELECT doc_id, text, t, list_position(list_transform(t, lambda x: lower(x)), 'but') AS but,
        len(list_filter(t, lambda x: upper(x) = x AND lower(x) <> x)) AS caps FROM w),
    p AS (SELECT doc_id, t, coalesce(but, 0) AS but, caps > 0 AND caps < len(t) AS mixed, unnest(range(1, len(t) + 1)) AS i FROM m),
    h AS (SELECT doc_id, but, mixed, i, t[i] AS word, CASE WHEN i > 1 THEN lower(t[i - 1]) END AS b1,
        CASE WHEN i > 2 THEN lower(t[i - 2]) END AS b2, CASE WHEN i > 3 THEN lower(t[i - 3]) END AS b3 FROM p),
    s0 AS (SELECT h.*, valence + CASE WHEN mixed AND upper(word) = word AND lower(word) <> word
        THEN sign(valence) * 0.733 ELSE 0 END AS v0 FROM h JOIN lex ON lower(word) = term),
    {", ".join(steps)},
    g AS (SELECT doc_id, sum(v3 * CASE WHEN but = 0 OR i = but THEN 1.0 WHEN i < but THEN 0.5 ELSE 1.5 END) AS s FROM s3 GROUP BY 1),
    e AS (SELECT doc_id, coalesce(s, 0) AS s, least(len(regexp_extract_all(text, '!')), 4) * 0.292 + CASE
        WHEN len(regexp_extract_all(text, '\?')) <= 1 THEN 0 WHEN len(regexp_extract_all(text, '\?')) <= 3
        THEN len(regexp_extract_all(text, '\?')) * 0.18 ELSE 0.96 END AS a FROM documents LEFT JOIN g USING (doc_id)),
    f AS (SELECT doc_id, CAST(s + sign(s) * a AS DOUBLE) AS s FROM e)
    SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound FROM f
    """


@query("lexicon_sentiment", _sentiment_sql())
def lexicon_sentiment(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"), "doc_id")
    scored = with_sentiment(texts, "doc_id", "text", word_valences(t), BOOSTERS, DAMPENERS, NEGATIONS)
    return scored.select("doc_id", F.col("compound_sentiment_score").alias("compound"))


def name_list(t: Tables) -> DataFrame:
    """Capitalised words of the benchmark texts, alone and with the word after them, as names."""
    words = t.benchmark.select(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_']+"), F.lit(0)).alias("w"))
    spans = F.transform(
        "w", lambda x, i: F.array(x, F.when(i + 1 < F.size("w"), F.concat_ws(" ", x, F.get("w", i + 1))))
    )
    names = exploded_terms(words, [], F.flatten(spans), "surface").where(F.rlike("surface", F.lit(r"^\p{Lu}")))
    types = F.array(*[F.lit(x) for x in ENTITY_TYPES])
    return names.distinct().withColumn("entity_type", F.get(types, F.pmod(F.length("surface"), F.lit(len(ENTITY_TYPES)))))


@query(
    "gazetteer_counts",
    rf"""
    WITH RECURSIVE b AS (SELECT regexp_extract_all(text, '[\p{{L}}\p{{N}}_'']+') AS w FROM benchmark),
    n AS (SELECT DISTINCT s FROM (SELECT unnest(w) AS s FROM b UNION ALL
        SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM b)
        WHERE regexp_matches(s, '^\p{{Lu}}')),
    z AS (SELECT s, ({[*ENTITY_TYPES]})[length(s) % 6 + 1] AS k FROM n),
    d AS (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_'']+') AS w FROM documents),
    g AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, 1 AS n, w FROM d
      UNION ALL SELECT doc_id, unnest(range(1, len(w))) AS p, 2, w FROM d
      UNION ALL SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, 3, w FROM d),
    h AS (SELECT doc_id, p, n, k FROM g JOIN z ON s = array_to_string(w[p:p + n - 1], ' ')),
    l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id, p ORDER BY n DESC, k) = 1),
    x AS (SELECT a.doc_id, a.p, a.k, b.p AS q FROM l a ASOF LEFT JOIN l b ON a.doc_id = b.doc_id AND a.p + a.n <= b.p),
    m AS (SELECT doc_id, p, k, q FROM x QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p) = 1
      UNION ALL SELECT x.doc_id, x.p, x.k, x.q FROM m JOIN x ON x.doc_id = m.doc_id AND x.p = m.q),
    c AS (SELECT doc_id, {", ".join(f"count(*) FILTER (k = '{e}') AS e{i}" for i, e in enumerate(ENTITY_TYPES))}
          FROM m GROUP BY 1)
    SELECT doc_id, {", ".join(f"CAST(coalesce(e{i}, 0) AS INT) AS entity_{e}" for i, e in enumerate(ENTITY_TYPES))}
    FROM documents LEFT JOIN c USING (doc_id)
    """,
)
def gazetteer_counts(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"), "doc_id")
    return with_entity_counts(texts, "doc_id", "text", name_list(t)).drop("text")
