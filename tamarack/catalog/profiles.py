"""Cleaning, joining and profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.registry import TEST_KEYWORDS, Tables, big, query, rounded
from tamarack.functions.dates import days_between, parse_date
from tamarack.functions.parsing import duration_lenient, duration_strict, parse_list
from tamarack.functions.text import token_count, with_keyword_flags, with_token_stats
from tamarack.operators import clean, correlation, profile
from tamarack.operators.joins import lookup_join, skew_join
from tamarack.operators.ordering import dense_codes
from tamarack.operators.selection import exact_quantiles, percentile_rank
from tamarack.operators.sketches import DISTINCT_ERROR, RANK_ERROR, merge_sketches, read_sketches, sketch_columns
from tamarack.session import cut_lineage, spread
from tamarack.sources.readers import info

TOKENS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_'']+|[^\p{L}\p{N}_''\s]'))"
SENTENCES = r"""greatest(1, len(regexp_extract_all(text, '[.!?]+(\s|$)')))"""
LETTERS = r"length(regexp_replace(text, '\s+', '', 'g'))"


@query(
    "toxic_rate_by_length_quartile",
    rf"""
    WITH sized AS (SELECT doc_id, source, {TOKENS} AS wc FROM documents),
    ranked AS (
      SELECT doc_id, wc,
        (rank() OVER (PARTITION BY source ORDER BY wc)
         + (count(*) OVER (PARTITION BY source, wc) - 1) / 2.0)
        / count(wc) OVER (PARTITION BY source) AS pct
      FROM sized)
    SELECT CAST(ceil(pct * 4) AS BIGINT) AS quartile, count(*) AS n,
      round(avg(toxic) * 100, 6) AS toxic_rate, round(avg(wc), 6) AS mean_words
    FROM ranked JOIN labels USING (doc_id) GROUP BY 1
    """,
)
def toxic_rate_by_length_quartile(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "source", "text"), "doc_id")
    sized = texts.select("doc_id", "source", token_count("text").alias("word_count"))
    ranked = percentile_rank(sized, ["source"], "word_count", "pct", ["doc_id"])
    out = (
        ranked.join(t.labels, "doc_id")
        .groupBy(big(F.ceil(F.col("pct") * 4)).alias("quartile"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.avg("toxic") * 100).alias("toxic_rate"),
            F.avg("word_count").alias("mean_words"),
        )
    )
    return rounded(out, 6, "toxic_rate", "mean_words")


@query(
    "dedup_keep_first",
    """
    SELECT doc_id, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY n_chars, doc_id) = 1
    """,
)
def dedup_keep_first(t: Tables) -> DataFrame:
    return clean.keep_first(t.documents, "text", ["n_chars", "doc_id"]).select("doc_id", "source", "n_chars")


@query(
    "category_codes",
    """
    WITH c AS (SELECT o_orderkey, nullif(o_orderpriority, '2-HIGH') AS p FROM orders)
    SELECT o_orderkey, CAST(CASE WHEN p IS NULL THEN -1
      ELSE dense_rank() OVER (ORDER BY p NULLS LAST) - 1 END AS BIGINT) AS code FROM c
    """,
)
def category_codes(t: Tables) -> DataFrame:
    priority = F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderpriority"))
    rows = t.orders.select("o_orderkey", priority.alias("p"))
    return dense_codes(rows, "p", "code", ["o_orderkey"]).select("o_orderkey", big("code").alias("code"))


@query(
    "user_codes",
    """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY 'user' || o_custkey) - 1 AS BIGINT) AS code FROM orders
    """,
)
def user_codes(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.concat(F.lit("user"), F.col("o_custkey")).alias("u"))
    return dense_codes(rows, "u", "code", ["o_orderkey"]).select("o_orderkey", big("code").alias("code"))


@query(
    "fill_and_error_to_zero",
    rf"""
    WITH d AS (SELECT doc_id, toxic, CASE WHEN lang <> 'de' THEN text ELSE '' END AS text,
                      CASE WHEN lang <> 'de' THEN source END AS source
               FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id, coalesce(toxic, 0) AS toxic, coalesce(source, 'Unknown') AS source,
      CAST({TOKENS} AS BIGINT) AS word_count,
      CASE WHEN {TOKENS} = 0 THEN 0 ELSE round({LETTERS} / {TOKENS}, 6) END AS avg_word_length,
      CASE WHEN trim(text) = '' THEN 0 ELSE {SENTENCES} END AS num_sentences
    FROM d
    """,
)
def fill_and_error_to_zero(t: Tables) -> DataFrame:
    known = F.col("lang") != "de"
    holes = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "toxic", F.when(known, F.col("text")).alias("text"), F.when(known, F.col("source")).alias("source")
    )
    filled = clean.fill_missing(holes, {"toxic": 0, "source": "Unknown"})
    out = with_token_stats(filled, "text").select(
        "doc_id", "toxic", "source", big("word_count").alias("word_count"), "avg_word_length",
        big("num_sentences").alias("num_sentences"),
    )
    return rounded(out, 6, "avg_word_length")


DURATIONS = """
    SELECT p_partkey, CASE p_partkey % 5
      WHEN 0 THEN concat(p_size // 10, 'h ', p_size, 'min') WHEN 1 THEN concat(p_size // 10, 'h')
      WHEN 2 THEN concat(p_size, 'min') WHEN 3 THEN NULL ELSE concat(p_size // 10, 'h ', p_size, 'm') END AS d
    FROM part
"""


def _durations(t: Tables) -> DataFrame:
    hours, size = F.floor(F.col("p_size") / 10).cast("string"), F.col("p_size").cast("string")
    kind = F.pmod("p_partkey", F.lit(5))
    text = (
        F.when(kind == 0, F.concat(hours, F.lit("h "), size, F.lit("min")))
        .when(kind == 1, F.concat(hours, F.lit("h")))
        .when(kind == 2, F.concat(size, F.lit("min")))
        .when(kind == 4, F.concat(hours, F.lit("h "), size, F.lit("m")))
    )
    return t.part.select("p_partkey", text.alias("d"))


@query(
    "parse_duration_strict",
    rf"""
    WITH x AS ({DURATIONS})
    SELECT p_partkey, CAST(CASE WHEN regexp_matches(coalesce(d, ''), '^\d+h \d+min') THEN
      CAST(regexp_extract(d, '^(\d+)h', 1) AS INT) * 60 + CAST(regexp_extract(d, 'h (\d+)min', 1) AS INT)
      ELSE 0 END AS BIGINT) AS minutes FROM x
    """,
)
def parse_duration_strict(t: Tables) -> DataFrame:
    return _durations(t).select("p_partkey", big(duration_strict("d")).alias("minutes"))


@query(
    "parse_duration_lenient",
    rf"""
    WITH x AS ({DURATIONS})
    SELECT p_partkey, CAST(CASE WHEN d IS NOT NULL THEN
      coalesce(TRY_CAST(nullif(regexp_extract(d, '(\d+)h', 1), '') AS INT), 0) * 60
      + coalesce(TRY_CAST(nullif(regexp_extract(d, '(\d+)m', 1), '') AS INT), 0) END AS BIGINT) AS minutes FROM x
    """,
)
def parse_duration_lenient(t: Tables) -> DataFrame:
    return _durations(t).select("p_partkey", big(duration_lenient("d")).alias("minutes"))


@query(
    "parse_dates_coerce",
    """
    WITH x AS (SELECT o_orderkey, CASE o_orderkey % 4
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d %B %Y')
      WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE 'nope' END AS s FROM orders)
    SELECT o_orderkey, CAST(coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%d %B %Y'),
      try_strptime(s, '%Y')) AS DATE) AS parsed FROM x
    """,
)
def parse_dates_coerce(t: Tables) -> DataFrame:
    kind = F.pmod("o_orderkey", F.lit(4))
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(kind == 1, F.date_format("o_orderdate", "d MMMM yyyy"))
        .when(kind == 2, F.date_format("o_orderdate", "yyyy"))
        .otherwise("nope")
    )
    return t.orders.select("o_orderkey", parse_date(text).alias("parsed"))


@query(
    "parse_list_literal",
    """
    SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS items,
      array_to_string(string_split(p_name, ' '), '|') AS joined FROM part
    """,
)
def parse_list_literal(t: Tables) -> DataFrame:
    literal = F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', \""), F.lit("']"))
    literal = F.when(F.contains("p_name", F.lit(" ")), F.regexp_replace(literal, "'\\]$", "\"]")).otherwise(literal)
    parsed = t.part.select("p_partkey", parse_list(literal).alias("l"))
    return parsed.select("p_partkey", big(F.size("l")).alias("items"), F.array_join("l", "|").alias("joined"))


@query(
    "fact_dim_inner",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS rating_x, p_size AS rating_y, p_brand
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def fact_dim_inner(t: Tables) -> DataFrame:
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("rating_x"), "l_extendedprice")
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("rating_y"), "p_brand")
    joined = lookup_join(facts, items, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "rating_x", "rating_y", "p_brand")


@query(
    "fact_dim_salted",
    """
    SELECT r_flag, p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS price
    FROM (SELECT l_returnflag AS r_flag, l_extendedprice, CASE WHEN l_linenumber < 3 THEN 7 ELSE l_partkey END AS k
          FROM lineitem) JOIN part ON k = p_partkey GROUP BY ALL
    """,
)
def fact_dim_salted(t: Tables) -> DataFrame:
    """A third of the fact rows share one key here; the join cuts it into pieces."""
    facts = t.lineitem.select(
        F.col("l_returnflag").alias("r_flag"), "l_extendedprice", "l_orderkey",
        F.when(F.col("l_linenumber") < 3, F.lit(7)).otherwise(F.col("l_partkey")).cast("bigint").alias("k"),
    )
    items = t.part.select(F.col("p_partkey").alias("k"), "p_brand")
    joined = skew_join(facts, items, ["k"], ["l_orderkey", "l_extendedprice"])
    return joined.groupBy("r_flag", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@query(
    "left_join_group_stats",
    """
    WITH s AS (SELECT l_partkey, avg(l_quantity) AS m, median(l_quantity) AS d, stddev_samp(l_quantity) AS v
               FROM lineitem GROUP BY 1)
    SELECT p_partkey, p_brand, round(m, 6) AS rating_mean, round(d, 6) AS rating_median, round(v, 6) AS rating_std
    FROM part LEFT JOIN s ON p_partkey = l_partkey
    """,
)
def left_join_group_stats(t: Tables) -> DataFrame:
    stats = profile.group_stats(t.lineitem.select("l_partkey", "l_quantity"), ["l_partkey"], "l_quantity", "rating")
    stats = stats.withColumnRenamed("l_partkey", "p_partkey")
    out = t.part.select("p_partkey", "p_brand").join(stats, "p_partkey", "left")
    return rounded(out, 6, "rating_mean", "rating_median", "rating_std")


@query(
    "null_profile",
    """
    WITH d AS (SELECT doc_id, quality, toxic, nullif(lang, 'de') AS lang FROM documents LEFT JOIN labels USING (doc_id))
    SELECT c AS column_name, CAST(m AS BIGINT) AS missing, round(m * 100.0 / n, 6) AS missing_percent FROM (
      SELECT 'doc_id' AS c, count(*) - count(doc_id) AS m, count(*) AS n FROM d UNION ALL
      SELECT 'lang', count(*) - count(lang), count(*) FROM d UNION ALL
      SELECT 'quality', count(*) - count(quality), count(*) FROM d UNION ALL
      SELECT 'toxic', count(*) - count(toxic), count(*) FROM d)
    """,
)
def null_profile(t: Tables) -> DataFrame:
    holes = t.documents.select("doc_id", F.expr("nullif(lang, 'de')").alias("lang")).join(t.labels, "doc_id", "left")
    return rounded(profile.null_profile(holes), 6, "missing_percent")


@query(
    "missing_columns",
    """
    WITH d AS (SELECT count(*) AS n, count(toxic) AS k FROM documents LEFT JOIN labels USING (doc_id))
    SELECT c AS column_name, n - k AS missing, round((n - k) * 100.0 / n, 6) AS missing_percent
    FROM d, (VALUES ('quality'), ('toxic')) v(c) WHERE n > k
    """,
)
def missing_columns(t: Tables) -> DataFrame:
    holes = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rounded(profile.null_profile(holes, missing_only=True), 6, "missing_percent")


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont({c}, 0.25), 4) AS q25,
        round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM {table}"""
        for c in columns
    )


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("describe_numeric", _describe_sql("lineitem", NUMBERS))
def describe_numeric(t: Tables) -> DataFrame:
    return rounded(profile.describe_numeric(t.lineitem, NUMBERS), 4, "mean", "std", "q25", "q50", "q75")


STRINGS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query(
    "describe_string",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, sum(n)::BIGINT AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top,
        max(n) AS freq FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders GROUP BY 1)"""
        for c in STRINGS
    ),
)
def describe_string(t: Tables) -> DataFrame:
    return profile.describe_string(t.orders, STRINGS)


@query(
    "describe_dates",
    """
    WITH d AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS v FROM orders)
    SELECT 'o_orderdate' AS feature, count(v) AS count, DATE '1970-01-01' + CAST(floor(avg(v)) AS INT) AS mean,
      DATE '1970-01-01' + CAST(min(v) AS INT) AS min, DATE '1970-01-01' + CAST(max(v) AS INT) AS max,
      DATE '1970-01-01' + CAST(floor(quantile_cont(v, 0.25)) AS INT) AS q25,
      DATE '1970-01-01' + CAST(floor(quantile_cont(v, 0.5)) AS INT) AS q50,
      DATE '1970-01-01' + CAST(floor(quantile_cont(v, 0.75)) AS INT) AS q75 FROM d
    """,
)
def describe_dates(t: Tables) -> DataFrame:
    return profile.describe_dates(t.orders, ["o_orderdate"])


@query(
    "table_info",
    """
    SELECT * FROM (SELECT count(doc_id) AS non_null, 'doc_id' AS column_name, 'bigint' AS data_type FROM documents
      UNION ALL SELECT count(text), 'text', 'string' FROM documents
      UNION ALL SELECT count(lang), 'lang', 'string' FROM documents
      UNION ALL SELECT count(source), 'source', 'string' FROM documents
      UNION ALL SELECT count(n_chars), 'n_chars', 'bigint' FROM documents)
    """,
)
def table_info(t: Tables) -> DataFrame:
    return info(t.documents)


@query("preview", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def preview(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars").orderBy("doc_id").limit(5)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.events, "event_type")


@query(
    "value_share",
    "SELECT lang, count(*) AS n, round(count(*) / (SELECT count(lang) FROM documents), 6) AS share FROM documents GROUP BY 1",
)
def value_share(t: Tables) -> DataFrame:
    return rounded(profile.value_shares(t.documents, "lang"), 6, "share")


@query(
    "class_balance",
    """
    SELECT count(*) FILTER (toxic = 0) AS negatives, count(*) FILTER (toxic = 1) AS positives,
      round(count(*) FILTER (toxic = 0) / nullif(count(*) FILTER (toxic = 1), 0), 6) AS imbalance_ratio,
      least(count(*) FILTER (toxic = 0), count(*) FILTER (toxic = 1)) AS minority FROM labels
    """,
)
def class_balance(t: Tables) -> DataFrame:
    return rounded(profile.class_balance(t.labels, "toxic"), 6, "imbalance_ratio")


@query(
    "monthly_counts",
    """
    WITH m AS (SELECT last_day(o_orderdate) AS month_end, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
    g AS (SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', min(month_end)) FROM m),
            (SELECT max(month_end) FROM m)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE)) AS month_end)
    SELECT month_end, coalesce(n, 0) AS n FROM g LEFT JOIN m USING (month_end)
    """,
)
def monthly_counts(t: Tables) -> DataFrame:
    return profile.monthly_counts(t.orders, "o_orderdate")


@query(
    "weekday_counts",
    """
    SELECT CAST(isodow(o_orderdate) - 1 AS BIGINT) AS day_order, dayname(o_orderdate) AS day_of_week, count(*) AS n
    FROM orders GROUP BY ALL
    """,
)
def weekday_counts(t: Tables) -> DataFrame:
    counts = profile.weekday_counts(t.orders, "o_orderdate")
    return counts.select(big("day_order").alias("day_order"), "day_of_week", "n")


@query("year_counts", "SELECT CAST(year(o_orderdate) AS BIGINT) AS release_year, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def year_counts(t: Tables) -> DataFrame:
    years = t.orders.select(big(F.year("o_orderdate")).alias("release_year"))
    return profile.value_counts(years, "release_year").orderBy("release_year")


def _histogram_sql(source: str, bins: str, by: str | None = None) -> str:
    """Histogram of column v of a sub-query; ``bins`` is an expression over b."""
    also = f", {by}" if by else ""
    grid_by = f"CROSS JOIN (SELECT DISTINCT {by} FROM x)" if by else ""
    return f"""
    WITH x AS ({source}),
    b0 AS (SELECT CAST(min(v) AS DOUBLE) AS lo, CAST(max(v) AS DOUBLE) AS hi, count(v) AS n,
                  quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM x),
    b AS (SELECT lo, hi, CAST({bins} AS INT) AS bins FROM b0),
    c AS (SELECT least(floor((v - lo) / (hi - lo) * bins) + 1, bins)::INT AS bin{also}, count(*) AS n
          FROM x CROSS JOIN b GROUP BY ALL),
    g AS (SELECT unnest(range(1, bins + 1))::INT AS bin, lo, (hi - lo) / bins AS w FROM b)
    SELECT g.bin{also}, round(lo + (g.bin - 1) * w, 4) AS bin_low, round(lo + g.bin * w, 4) AS bin_high,
      coalesce(c.n, 0) AS n
    FROM g {grid_by} LEFT JOIN c USING (bin{also})
    """


def _histogram(df: DataFrame) -> DataFrame:
    return rounded(df.drop("feature"), 4, "bin_low", "bin_high")


@query("hist_20", _histogram_sql("SELECT o_totalprice AS v FROM orders", "20"))
def hist_20(t: Tables) -> DataFrame:
    return _histogram(profile.histograms(t.orders, ["o_totalprice"], 20))


@query(
    "hist_auto",
    _histogram_sql(
        "SELECT n_chars AS v FROM documents",
        "greatest(1, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), CASE WHEN iqr > 0 THEN 2 * iqr / cbrt(n) ELSE hi - lo END)))",
    ),
)
def hist_auto(t: Tables) -> DataFrame:
    return _histogram(profile.histograms(t.documents, ["n_chars"]))


@query(
    "hist_by_class",
    _histogram_sql("SELECT n_chars AS v, toxic FROM documents JOIN labels USING (doc_id)", "30", "toxic"),
)
def hist_by_class(t: Tables) -> DataFrame:
    return _histogram(profile.histograms(t.labelled(), ["n_chars"], 30, by="toxic"))


@query(
    "kde_grid",
    """
    WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi, count(*)::DOUBLE AS n,
                      stddev_samp(n_chars) * power(count(*)::DOUBLE, -0.2) AS w FROM documents),
    g AS (SELECT unnest(range(200))::INT AS point)
    SELECT point, round(lo + point * ((hi - lo) / 199), 4) AS x,
      round(1e6 * sum(exp(-0.5 * power((lo + point * ((hi - lo) / 199) - n_chars) / w, 2)) / (n * w * sqrt(2 * pi()))), 4)
        AS density_ppm
    FROM g CROSS JOIN s CROSS JOIN documents GROUP BY point, lo, hi
    """,
)
def kde_grid(t: Tables) -> DataFrame:
    curve = profile.density(t.documents, "n_chars")
    return curve.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 4).alias("density_ppm"))


@query(
    "kde_binned",
    """
    WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi, count(*)::DOUBLE AS n,
                      stddev_samp(n_chars) * power(count(*)::DOUBLE, -0.2) AS w FROM documents),
    v AS (SELECT (n_chars - lo) / ((hi - lo) / 4096) AS p FROM documents, s WHERE n_chars IS NOT NULL),
    l AS (SELECT p, least(floor(p), 4095) AS i FROM v),
    c AS (SELECT i, sum(w) AS c FROM (SELECT i, 1 - (p - i) AS w FROM l UNION ALL SELECT i + 1, p - i FROM l) GROUP BY 1),
    g AS (SELECT unnest(range(200))::INT AS point)
    SELECT point, round(lo + point * ((hi - lo) / 199), 4) AS x,
      round(1e6 * sum(c * exp(-0.5 * power((lo + point * ((hi - lo) / 199) - (lo + i * ((hi - lo) / 4096))) / w, 2))
        / (n * w * sqrt(2 * pi()))), 4) AS density_ppm
    FROM g CROSS JOIN s CROSS JOIN c GROUP BY point, lo, hi
    """,
)
def kde_binned(t: Tables) -> DataFrame:
    curve = profile.binned_density(t.documents, "n_chars")
    return curve.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 4).alias("density_ppm"))


@query(
    "box_by_group",
    """
    WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q25, quantile_cont(l_extendedprice, 0.5) AS q50,
                      quantile_cont(l_extendedprice, 0.75) AS q75 FROM lineitem GROUP BY 1)
    SELECT l_returnflag, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75,
      min(l_extendedprice) FILTER (inside) AS whisker_low, max(l_extendedprice) FILTER (inside) AS whisker_high,
      count(*) FILTER (NOT inside) AS outliers
    FROM (SELECT *, l_extendedprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside
          FROM lineitem JOIN q USING (l_returnflag)) GROUP BY l_returnflag, q25, q50, q75
    """,
)
def box_by_group(t: Tables) -> DataFrame:
    boxes = profile.box_stats(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return rounded(boxes, 4, "q25", "q50", "q75")


@query(
    "p95_clip",
    """
    SELECT source, count(*) AS n, max(n_chars) AS longest FROM documents
    WHERE n_chars >= 0 AND n_chars <= (SELECT quantile_cont(n_chars, 0.95) FROM documents) GROUP BY 1
    """,
)
def p95_clip(t: Tables) -> DataFrame:
    kept = profile.clip_to_quantile(t.documents.select("source", "n_chars"), "n_chars")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest"))


@query(
    "group_quantiles",
    """
    SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(median(l_extendedprice), 4) AS q50,
      round(quantile_cont(l_extendedprice, 0.95), 4) AS q95 FROM lineitem GROUP BY 1
    """,
)
def group_quantiles(t: Tables) -> DataFrame:
    wanted = {"q25": 0.25, "q50": 0.5, "q95": 0.95}
    return rounded(exact_quantiles(t.lineitem, ["l_suppkey"], "l_extendedprice", wanted), 4, *wanted)


@query("min_max", "SELECT min(p_retailprice) AS low, max(p_retailprice) AS high FROM part")
def min_max(t: Tables) -> DataFrame:
    return t.part.agg(F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))


@query(
    "events_per_user_hist",
    _histogram_sql("SELECT count(*) AS v FROM events WHERE user_id IS NOT NULL GROUP BY user_id", "50"),
)
def events_per_user_hist(t: Tables) -> DataFrame:
    return _histogram(profile.activity_distribution(t.events, "user_id", 50))


@query("top10_users", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top10_users(t: Tables) -> DataFrame:
    return profile.top_values(t.events, "user_id", 10)


@query(
    "rate_by_key",
    "SELECT source, round(avg(toxic) * 100, 6) AS rate, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1",
)
def rate_by_key(t: Tables) -> DataFrame:
    return rounded(profile.rate_by(t.labelled(), "source", "toxic"), 6, "rate")


@query(
    "lag_bin_rate",
    """
    WITH x AS (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d,
                      CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    v AS (SELECT * FROM (VALUES (0, 'First Week', -1, 7), (1, 'First Month', 7, 30), (2, '1-3 Months', 30, 90),
      (3, '3-6 Months', 90, 180), (4, '6-12 Months', 180, 365), (5, 'Over a Year', 365, 1000000)) t(bin_order, lag_bin, lo, hi))
    SELECT CAST(bin_order AS BIGINT) AS bin_order, lag_bin, round(avg(y) * 100, 6) AS rate, count(y) AS n
    FROM v LEFT JOIN x ON d > lo AND d <= hi GROUP BY 1, 2
    """,
)
def lag_bin_rate(t: Tables) -> DataFrame:
    facts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_returnflag")
    dated = facts.join(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey").select(
        days_between("l_shipdate", "o_orderdate").alias("days"), (F.col("l_returnflag") == "R").alias("returned")
    )
    bins = profile.lag_bin_rate(dated, "days", "returned")
    return rounded(bins.select(big("bin_order").alias("bin_order"), "lag_bin", "rate", "n"), 6, "rate")


@query(
    "genre_mean_count_having",
    """
    SELECT genre, round(avg(p_retailprice), 4) AS mean, count(p_retailprice) AS count
    FROM (SELECT unnest(string_split(p_name, ' ')) AS genre, p_retailprice FROM part) GROUP BY 1 HAVING count(p_retailprice) >= 5
    """,
)
def genre_mean_count_having(t: Tables) -> DataFrame:
    parts = t.part.select(F.split("p_name", " ").alias("genre"), "p_retailprice")
    genres = profile.exploded(parts, "genre", ["p_retailprice"])
    return rounded(profile.mean_and_count(genres, "genre", "p_retailprice", min_count=5), 4, "mean")


@query(
    "top15_genres",
    """
    SELECT genre, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15
    """,
)
def top15_genres(t: Tables) -> DataFrame:
    parts = t.part.select(F.split("p_name", " ").alias("genre"))
    return profile.top_values(profile.exploded(parts, "genre", []), "genre", 15)


@query(
    "scatter_bins",
    """
    WITH s AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem)
    SELECT least(floor((l_quantity - x0) / (x1 - x0) * 20) + 1, 20)::INT AS bin_x,
      least(floor((l_extendedprice - y0) / (y1 - y0) * 20) + 1, 20)::INT AS bin_y, l_returnflag, count(*) AS n
    FROM lineitem CROSS JOIN s GROUP BY ALL
    """,
)
def scatter_bins(t: Tables) -> DataFrame:
    return profile.scatter_bins(t.lineitem, "l_quantity", "l_extendedprice", 20, by="l_returnflag")


FLAG_SQL = ", ".join(
    f"CAST(contains(lower(text), '{k}') AS INT) AS \"has_{k}\"" for k in TEST_KEYWORDS
)


@query(
    "column_sums",
    f"WITH f AS (SELECT {FLAG_SQL} FROM documents) "
    + " UNION ALL ".join(f"SELECT 'has_{k}' AS feature, sum(\"has_{k}\")::DOUBLE AS total FROM f" for k in TEST_KEYWORDS),
)
def column_sums(t: Tables) -> DataFrame:
    flagged = with_keyword_flags(t.documents, "text", TEST_KEYWORDS)
    return profile.column_sums(flagged, clean.columns_with_prefix(flagged, "has_"))


@query(
    "family_means_by_class",
    f"WITH f AS (SELECT toxic, {FLAG_SQL} FROM documents JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT toxic, 'has_{k}' AS feature, round(avg(\"has_{k}\"), 6) AS mean FROM f GROUP BY 1" for k in TEST_KEYWORDS
    ),
)
def family_means_by_class(t: Tables) -> DataFrame:
    flagged = with_keyword_flags(t.labelled(), "text", TEST_KEYWORDS)
    means = profile.family_means(flagged, clean.columns_with_prefix(flagged, "has_"), "toxic")
    return rounded(means, 6, "mean")


@query(
    "cumulative_share",
    """
    WITH c AS (SELECT l_linenumber, sum(l_quantity) AS v FROM lineitem GROUP BY 1),
    r AS (SELECT l_linenumber, v, sum(v) OVER (ORDER BY l_linenumber) / sum(v) OVER () AS c,
                 (sum(v) OVER (ORDER BY l_linenumber) - v) / sum(v) OVER () AS b FROM c)
    SELECT l_linenumber, v, round(c, 6) AS cumulative, c >= 0.8 AND b < 0.8 AS is_cut FROM r
    """,
)
def cumulative_share(t: Tables) -> DataFrame:
    totals = t.lineitem.groupBy("l_linenumber").agg(F.sum("l_quantity").alias("v"))
    return rounded(profile.cumulative_share(totals, "l_linenumber", "v", 0.8), 6, "cumulative")


@query("sample_size", "SELECT least(count(*), 2000) AS n FROM lineitem")
def sample_size(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice").alias("key"))
    return profile.hash_sample(rows, "key", 2000).agg(F.count(F.lit(1)).alias("n"))


TARGET_FEATURES = ["n_chars", "word_count", "num_sentences", "avg_word_length", *[f"has_{k}" for k in TEST_KEYWORDS]]
TARGET_SQL = rf"""
    SELECT toxic, n_chars, {TOKENS} AS word_count, {SENTENCES} AS num_sentences,
      {LETTERS} / {TOKENS} AS avg_word_length, {FLAG_SQL}
    FROM documents JOIN labels USING (doc_id)
"""


def target_frame(t: Tables) -> DataFrame:
    return with_keyword_flags(with_token_stats(t.labelled(), "text"), "text", TEST_KEYWORDS)


def _corr_sql(a: str, b: str) -> str:
    value = f'corr("{a}", "{b}")'
    return f"CASE WHEN isnan({value}) THEN NULL ELSE round({value}, 6) END"


TARGET_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_corr_sql(c, 'toxic')} AS correlation FROM f" for c in TARGET_FEATURES
)


@query("target_corr", f"WITH f AS ({TARGET_SQL}) {TARGET_CORR_SQL}")
def target_corr(t: Tables) -> DataFrame:
    return rounded(correlation.target_correlation(target_frame(t), [*TARGET_FEATURES, "toxic"], "toxic"), 6, "correlation")


MATRIX = ["n_chars", "word_count", "num_sentences", "avg_word_length", "toxic"]


@query(
    "corr_matrix",
    f"WITH f AS ({TARGET_SQL}) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {_corr_sql(a, b)} AS correlation FROM f" for a in MATRIX for b in MATRIX),
)
def corr_matrix(t: Tables) -> DataFrame:
    return rounded(correlation.correlation_matrix(target_frame(t), MATRIX), 6, "correlation")


@query(
    "corr_matrix_wide",
    """
    WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT 'v' || (p.i - 1) AS a, 'v' || (q.i - 1) AS b, round(corr(p.v, q.v), 6) AS correlation
    FROM x p JOIN x q USING (vec_id) GROUP BY p.i, q.i
    """,
)
def corr_matrix_wide(t: Tables) -> DataFrame:
    """All dimensions of the vectors against each other."""
    width = t.embeddings.agg(F.max(F.size("embedding"))).first()[0]
    names = [f"v{i}" for i in range(width)]
    wide = t.embeddings.select(*[F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return rounded(correlation.correlation_matrix(wide, names), 6, "correlation")


@query(
    "feature_rank_top30",
    f"""WITH f AS ({TARGET_SQL}), c AS ({TARGET_CORR_SQL})
    SELECT feature, abs(correlation) AS importance FROM c WHERE correlation IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 30""",
)
def feature_rank_top30(t: Tables) -> DataFrame:
    return rounded(correlation.rank_features(target_frame(t), TARGET_FEATURES, "toxic", 30), 6, "importance")


@query(
    "top_bottom_features",
    f"""WITH f AS ({TARGET_SQL}), c AS ({TARGET_CORR_SQL}), k AS (SELECT * FROM c WHERE correlation IS NOT NULL)
    SELECT * FROM (SELECT *, 'top' AS side FROM k ORDER BY correlation DESC, feature LIMIT 5)
    UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM k ORDER BY correlation, feature LIMIT 5)""",
)
def top_bottom_features(t: Tables) -> DataFrame:
    return rounded(correlation.top_and_bottom(target_frame(t), TARGET_FEATURES, "toxic", 5), 6, "correlation")


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "sketched_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) AS "rows", count(*) - count({c}) AS missing, CAST(min({c}) AS DOUBLE) AS low,
        CAST(max({c}) AS DOUBLE) AS high, round(avg({c}), 4) AS mean, TRUE AS distinct_fits, TRUE AS quantiles_fit FROM lineitem"""
        for c in SKETCHED
    ),
)
def sketched_profile(t: Tables) -> DataFrame:
    """Sketches per ship month, merged; estimates are held against exact counts of the same table, at twice the stated errors."""
    wanted = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    parts = sketch_columns(t.lineitem.withColumn("_month", F.trunc("l_shipdate", "MM")), SKETCHED, ["_month"])
    read = cut_lineage(read_sketches(merge_sketches(cut_lineage(parts)), wanted))
    long = profile.long_form(t.lineitem, SKETCHED).join(F.broadcast(read.select("feature", *wanted)), "feature")
    counts = [F.count(F.when(F.col("value") < F.col(q), 1)).alias(f"{q}_below") for q in wanted]
    counts += [F.count(F.when(F.col("value") <= F.col(q), 1)).alias(f"{q}_up_to") for q in wanted]
    exact = long.groupBy("feature").agg(F.count_distinct("value").alias("values"), F.count(F.lit(1)).alias("n"), *counts)
    slack = F.col("n") * 2 * RANK_ERROR
    fits = F.lit(True)
    for q, share in wanted.items():
        fits = fits & (F.col(f"{q}_below") - slack <= F.col("n") * share) & (F.col("n") * share <= F.col(f"{q}_up_to") + slack)
    return read.join(exact, "feature").select(
        "feature",
        "rows",
        "missing",
        "low",
        "high",
        F.round("mean", 4).alias("mean"),
        (F.abs(F.col("distinct") - F.col("values")) <= F.col("values") * 2 * DISTINCT_ERROR).alias("distinct_fits"),
        fits.alias("quantiles_fit"),
    )
