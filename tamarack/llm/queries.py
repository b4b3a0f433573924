"""The operators' registered queries, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm.common import crc_fold, table
from tamarack.llm.codes import near_embeddings
from tamarack.llm.containment import mark_leaks
from tamarack.llm.jaccard import near_duplicates
from tamarack.llm.katz import katz_scores
from tamarack.llm.ledger import scan_documents, span_text
from tamarack.llm.phrases import collocations
from tamarack.llm.pieces import encode_documents
from tamarack.llm.sharding import kd_shards
from tamarack.llm.topk import top_k
from tamarack.llm.toxicity import labelled, train_toxicity
from tamarack.llm.urls import PATTERN_RULES, SITE_RULES, compile_rule, judge_urls
from tamarack.llm.whitening import whiten
from tamarack.llm.wrapper import extract_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


@query()
def op1_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-d tree shards of near equal bytes."""
    shards = kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def _ledger_sql() -> str:
    kinds = (
        ("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 6),
        ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
        ("hex", r"([0-9a-f]{24,})", 1, 24),
    )
    parts = [
        f"""SELECT doc_id, {n} AS ord, '{kind}' AS kind, unnest(range(1, len(whole) + 1)) AS k, whole, part, cut, {least} AS least FROM (
        SELECT doc_id, regexp_extract_all(t, '{regex}', 0) AS whole, regexp_extract_all(t, '{regex}', {group}) AS part,
        string_split_regex(t, '{regex.replace("(", "(?:").replace("(?:?:", "(?:")}') AS cut FROM d)"""
        for n, (kind, regex, group, least) in enumerate(kinds)
    ]
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), hits AS ({" UNION ALL ".join(parts)}),
    places AS (SELECT doc_id, ord, kind, length(part[k]) AS size, least,
        list_sum(list_transform(cut[1:k], lambda s: length(s))) + coalesce(list_sum(list_transform(whole[1:k - 1], lambda s: length(s))), 0) AS b,
        length(whole[k]) AS n FROM hits),
    spans AS (SELECT doc_id, ord, kind, CAST(b AS BIGINT) AS b, CAST(b + n AS BIGINT) AS e FROM places WHERE size >= least),
    found AS (SELECT doc_id, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord) AS spans,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex FROM spans GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN found USING (doc_id)"""


@query(_ledger_sql())
def op4_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text through a new blob ledger. All rules are base rules, so all spans are base spans."""
    found = scan_documents(table(spark, sf_dir, "documents"))
    spans = span_text()
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans")
    )


def _urls_sql() -> str:
    site = ", ".join(f"('{s}', '{p}', '{v}')" for s, p, v in SITE_RULES)
    pattern = ", ".join("('{}', '{}', '{}')".format(r, *compile_rule(r)[:2]) for r in PATTERN_RULES)
    return f"""WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
    s AS (SELECT page_id, u, translate(regexp_extract(u, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(u, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM p),
    r(site, prefix, verdict) AS (VALUES {site}), q(rule, regex, verdict) AS (VALUES {pattern}),
    fit AS (SELECT page_id, arg_max(site || prefix, length(site || prefix)) AS rule, arg_max(verdict, length(site || prefix)) AS verdict
        FROM s JOIN r ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, prefix) GROUP BY page_id),
    pat AS (SELECT page_id, min({{'late': q.verdict = 'block', 'rule': q.rule, 'verdict': q.verdict}}) AS best FROM s
        JOIN q ON regexp_matches(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), q.regex) GROUP BY page_id)
    SELECT s.page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, pat.best.verdict, 'allow') AS verdict, pat.best.rule AS pattern
    FROM s LEFT JOIN fit USING (page_id) LEFT JOIN pat USING (page_id)"""


@query(_urls_sql())
def op10_rare_token_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


@query()
def op5_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op9_folded_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; learnt from the labels of three quarters of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(labelled(docs, table(spark, sf_dir, "labels")))
    held_out = crc_fold("doc_id", 4) == 2
    return model.score(docs).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""
)
def op6_columnar_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(
    f"""WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents), i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
    a AS (SELECT DISTINCT item_id, least(len(w), 5) AS n, array_to_string(w[k:k + least(len(w), 5) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS k FROM i)),
    b AS (SELECT DISTINCT doc_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM a))),
    z AS (SELECT item_id, count(*) AS size FROM a GROUP BY item_id)
    SELECT doc_id, item_id, CAST(any_value(size) AS INTEGER) AS item_shingles, CAST(count(*) AS INTEGER) AS shared
    FROM a JOIN b USING (n, g) JOIN z USING (item_id) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(size)"""
)
def op8_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold three quarters or more of a benchmark item's shingles, with the item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_leaks(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") > 0)
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query()
def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under a model of six sevenths of the documents."""
    held_out = (crc_fold("doc_id", 7) == 2).alias("held_out")
    return katz_scores(table(spark, sf_dir, "documents").select("doc_id", "text", held_out))


@query()
def op3_bitmap_tile_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op11_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every embedding; a deviation beyond a long is null."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE e IS NOT NULL
        AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
    reach AS (WITH RECURSIVE r(node, seen) AS (SELECT vec_id, vec_id FROM u UNION SELECT r.node, l.b FROM r JOIN links l ON l.a = r.seen)
        SELECT node, min(seen) AS component_id FROM r GROUP BY node),
    n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
        vec_id = coalesce(component_id, vec_id) AS kept FROM v LEFT JOIN n ON a = vec_id LEFT JOIN reach ON node = vec_id"""
)
def op13_rotated_code_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every embedding at cosine 0.9."""
    return near_embeddings(table(spark, sf_dir, "embeddings"))


@query(
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p), n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang),
    g AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM s, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT lang, k, g, f AS a, array_to_string(g, ' ') AS phrase FROM g WHERE k > 1),
    cut AS (SELECT c.lang, c.phrase, c.a, n.n, j, x.f AS l, y.f AS r, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN n USING (lang)
        JOIN g x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN g y ON y.lang = c.lang AND y.g = c.g[j + 1:]),
    low AS (SELECT lang, phrase, a, n, min({'score': score, 'j': j, 'l': l, 'r': r}) AS m FROM cut GROUP BY ALL),
    kept AS (SELECT lang, phrase, a, m.l AS l, m.r AS r, n, CAST(m.score AS BIGINT) AS score FROM low WHERE NOT EXISTS (
        SELECT 1 FROM c WHERE c.lang = low.lang AND c.a >= low.a AND length(c.phrase) > length(low.phrase)
            AND contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' ')))
    SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000"""
)
def op12_bidirectional_index_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))
