"""Vocabulary, TF-IDF, similarity, factor and matrix queries."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.registry import Tables, big, query, rounded
from tamarack.operators import factors, vectors
from tamarack.operators.neighbours import knn, knn_classify
from tamarack.operators.resample import smote
from tamarack.operators.scaling import class_weights, fit_scaler, standardize_columns
from tamarack.operators.similarity import pair_cosine
from tamarack.session import spread

WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


@query(
    "vocab_top_n",
    f"""
    SELECT term, count(*) AS tf FROM (SELECT unnest({WORDS}) AS term FROM documents)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5000
    """,
)
def vocab_top_n(t: Tables) -> DataFrame:
    return vectors.vocabulary(t.documents, "text", 5000)


@query(
    "vocab_hashed_counters",
    f"""
    WITH w AS (SELECT {WORDS} AS t FROM documents),
    g AS (SELECT unnest(t) AS term FROM w
      UNION ALL SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM w
      UNION ALL SELECT unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM w)
    SELECT term, count(*) AS tf FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5000
    """,
)
def vocab_hashed_counters(t: Tables) -> DataFrame:
    """The way of large inputs, whatever the table's size."""
    return vectors.vocabulary(t.documents, "text", 5000, vectors.TRIGRAMS, direct_bytes=-1)


@query(
    "tfidf_weights",
    f"""
    WITH w AS (SELECT doc_id, {WORDS} AS t FROM documents),
    g AS (SELECT doc_id, unnest(t) AS term FROM w
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM w
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM w),
    c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
    v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY 1
          ORDER BY sum(tf) DESC, term LIMIT 5000),
    x AS (SELECT doc_id, term, tf * idf AS w FROM c JOIN v USING (term)),
    n AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM x)
    SELECT term, count(*) AS docs, round(sum(w), 5) AS total, round(max(w), 6) AS top FROM n GROUP BY 1
    """,
)
def tfidf_weights(t: Tables) -> DataFrame:
    model, rows = vectors.fit_transform_tfidf(t.documents, "doc_id", "text", 5000)
    entries = vectors.vector_entries(rows, ["doc_id"], "tfidf")
    terms = t.spark.createDataFrame(list(enumerate(model.terms)), "position int, term string")
    weights = entries.groupBy("position").agg(
        F.count(F.lit(1)).alias("docs"), F.round(F.sum("weight"), 5).alias("total"), F.round(F.max("weight"), 6).alias("top")
    )
    return weights.join(F.broadcast(terms), "position").drop("position")


@query(
    "hashed_tf",
    f"""
    WITH w AS (SELECT doc_id, len({WORDS}) AS n FROM documents)
    SELECT doc_id, CAST(n + greatest(n - 1, 0) + greatest(n - 2, 0) AS BIGINT) AS terms FROM w
    """,
)
def hashed_tf(t: Tables) -> DataFrame:
    """Bucket numbers depend on the hash; the total per text does not."""
    counter = HashingTF(numFeatures=5000, inputCol="_terms", outputCol="_tf")
    texts = spread(t.documents.select("doc_id", "text"), "doc_id")
    counted = vectors.counted_terms(texts, "text", vectors.TRIGRAMS, counter)
    total = F.aggregate(F.unwrap_udt("_tf").getField("values"), F.lit(0.0), lambda a, x: a + x)
    return counted.select("doc_id", big(total).alias("terms"))


@query(
    "pair_cosine",
    f"""
    WITH k AS (SELECT count(*) AS n FROM benchmark),
    r AS (SELECT doc_id, doc_id % n AS item_id, {WORDS} AS t FROM documents, k),
    i AS (SELECT item_id, {WORDS} AS t FROM benchmark),
    p AS (SELECT doc_id, r.t AS a, i.t AS b FROM r JOIN i USING (item_id)),
    u AS (SELECT doc_id, 0 AS side, unnest(a) AS term FROM p UNION ALL SELECT doc_id, 1, unnest(b) FROM p),
    c AS (SELECT doc_id, side, term, count(*) AS tf FROM u GROUP BY ALL),
    f AS (SELECT term, ln((1 + 2 * (SELECT count(*) FROM p)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY 1),
    w AS (SELECT doc_id, side, term, tf * idf AS w FROM c JOIN f USING (term)),
    l AS (SELECT doc_id, side, sqrt(sum(w * w)) AS l FROM w GROUP BY 1, 2),
    d AS (SELECT x.doc_id, sum(x.w * y.w) AS d FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.term = y.term
          AND x.side = 0 AND y.side = 1 GROUP BY 1)
    SELECT p.doc_id, round(coalesce(d / (x.l * y.l), 0), 6) AS similarity FROM p LEFT JOIN d USING (doc_id)
    LEFT JOIN l x ON x.doc_id = p.doc_id AND x.side = 0 LEFT JOIN l y ON y.doc_id = p.doc_id AND y.side = 1
    """,
)
def pair_cosine_query(t: Tables) -> DataFrame:
    items = t.benchmark.agg(F.count(F.lit(1))).scalar()
    texts = t.documents.select("doc_id", F.pmod("doc_id", items).alias("item_id"), "text")
    plots = t.benchmark.select("item_id", F.col("text").alias("plot"))
    scored = pair_cosine(texts, plots, "doc_id", "item_id", "text", "plot", "similarity")
    return rounded(scored, 6, "similarity")


def _document_vectors(t: Tables, sizes, hashing: bool) -> tuple[DataFrame, int]:
    model, rows = vectors.fit_transform_tfidf(t.documents, "doc_id", "text", 5000, sizes, hashing)
    return rows, model.scale.size


@query("svd_features")
def svd_features(t: Tables) -> DataFrame:
    rows, width = _document_vectors(t, vectors.TRIGRAMS, True)
    return factors.fit_svd(rows, "tfidf", width, 100).transform(rows, "doc_id", "tfidf")


@query("topic_features")
def topic_features(t: Tables) -> DataFrame:
    rows, _ = _document_vectors(t, vectors.UNIGRAMS, False)
    return factors.topic_features(factors.fit_topics(rows, "tfidf"), rows, "doc_id")


@query(
    "standardize",
    """
    WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings),
    s AS (SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM x GROUP BY 1)
    SELECT vec_id, CAST(dim AS BIGINT) AS dim, round((v - m) / s, 5) AS z FROM x JOIN s USING (dim)
    """,
)
def standardize(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    scaled = fit_scaler(rows, "v").transform(rows, "v", "z")
    long = scaled.select("vec_id", F.posexplode(vector_to_array("z")).alias("dim", "z"))
    return long.select("vec_id", big(F.col("dim") + 1).alias("dim"), F.round("z", 5).alias("z"))


@query(
    "standardize_columns",
    """
    SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS o_totalprice
    FROM orders
    """,
)
def standardize_columns_query(t: Tables) -> DataFrame:
    return rounded(standardize_columns(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice"]), 6, "o_totalprice")


@query(
    "class_weights",
    """
    SELECT label, round((SELECT count(*) FROM embeddings) / ((SELECT count(DISTINCT label) FROM embeddings) * count(*)), 6)
      AS weight FROM embeddings GROUP BY 1
    """,
)
def class_weights_query(t: Tables) -> DataFrame:
    return rounded(class_weights(t.embeddings, "label"), 6, "weight")


def _points(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")


@query(
    "knn_exact",
    """
    WITH d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id,
        list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    SELECT query_id, neighbour_id, round(distance, 6) AS distance,
      CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INT) AS rank
    FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) <= 5
    """,
)
def knn_exact(t: Tables) -> DataFrame:
    points = _points(t)
    found = knn(points, points, 5, "vec_id", "vec_id", "x", skip_self=True)
    return rounded(found.drop("payload"), 6, "distance")


@query(
    "knn_vote",
    """
    WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS x, CAST(label = 3 AS INT) AS y, hash(vec_id) AS h FROM embeddings),
    d AS (SELECT a.vec_id, b.y, list_distance(a.x, b.x) AS d, b.vec_id AS n FROM p a JOIN p b ON a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0),
    k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, n) <= 5),
    v AS (SELECT vec_id, y, CASE WHEN min(d) OVER (PARTITION BY vec_id) = 0 THEN CAST(d = 0 AS DOUBLE) ELSE 1 / d END AS w FROM k)
    SELECT vec_id, round(sum(w * y) / sum(w), 6) AS probability, CAST(sum(w * y) / sum(w) > 0.5 AS DOUBLE) AS prediction
    FROM v GROUP BY 1
    """,
)
def knn_vote(t: Tables) -> DataFrame:
    """A fifth of the rows asks the others; together they are the whole table."""
    rows = _points(t).withColumn("label", (F.col("label") == 3).cast("int"))
    asks = F.pmod("vec_id", F.lit(5)) == 0
    votes = knn_classify(rows.where(asks), rows.where(~asks), "vec_id", "vec_id", "x", "label", 5)
    return rounded(votes, 6, "probability")


@query(
    "smote_counts",
    """
    WITH c AS (SELECT CAST(label = 3 AS INT) AS label, count(*) AS n FROM embeddings GROUP BY 1)
    SELECT label, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS synthetic FROM c
    """,
)
def smote_counts(t: Tables) -> DataFrame:
    return smote_rows(t).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_synthetic"), 1)).alias("synthetic")
    )


@query("smote_rows")
def smote_rows(t: Tables) -> DataFrame:
    rows = _points(t).withColumn("label", (F.col("label") == 3).cast("int"))
    return smote(rows, "vec_id", "x", "label")


@query("pca_95")
def pca_95(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    scaled = fit_scaler(rows, "v").transform(rows, "v", "z")
    model = factors.fit_pca(scaled, "z", "reduced")
    return model.transform(scaled).select("vec_id", vector_to_array("reduced").alias("reduced"))


@query("pca_2d")
def pca_2d(t: Tables) -> DataFrame:
    rows, width = _document_vectors(t, vectors.TRIGRAMS, True)
    svd = factors.fit_svd(rows, "tfidf", width, 100).transform(rows, "doc_id", "tfidf")
    labelled = svd.join(t.labels.select("doc_id", "toxic"), "doc_id")
    return factors.project_2d(labelled, "doc_id", [f"svd_{i}" for i in range(100)], "toxic")[0]
