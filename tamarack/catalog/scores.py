"""Metric, voting and leaderboard queries.

The score under test is a fixed expression of the row, so that SQL can repeat it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.catalog.registry import Tables, query, rounded
from tamarack.operators import metrics, models

SCORED_SQL = """
    SELECT l_orderkey AS row_id, CAST(l_returnflag = 'R' AS INT) AS label,
      CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, l_extendedprice / l_quantity AS score
    FROM lineitem
"""


def scored(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("row_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("score"),
    )


@query(
    "confusion_matrix",
    f"""
    WITH s AS ({SCORED_SQL}), g AS (SELECT a AS label, b AS prediction FROM range(2) x(a), range(2) y(b))
    SELECT CAST(g.label AS INT) AS label, CAST(g.prediction AS INT) AS prediction, count(s.row_id) AS n
    FROM g LEFT JOIN s ON s.label = g.label AND s.prediction = g.prediction GROUP BY 1, 2
    """,
)
def confusion_matrix(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(scored(t), "label", "prediction")


@query(
    "classification_report",
    f"""
    WITH s AS ({SCORED_SQL}), k AS (SELECT CAST(c AS VARCHAR) AS c, count(*) FILTER (label = c AND prediction = c) AS h,
        count(*) FILTER (prediction = c) AS p, count(*) FILTER (label = c) AS y FROM s, range(2) r(c) GROUP BY 1),
    m AS (SELECT c AS "row", coalesce(h / nullif(p, 0), 0) AS precision, coalesce(h / nullif(y, 0), 0) AS recall,
        coalesce(2 * h / nullif(p + y, 0), 0) AS f1, y AS support FROM k),
    a AS (SELECT sum(h) / sum(y) AS a, sum(y)::BIGINT AS n FROM k)
    SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
      SELECT * FROM m UNION ALL SELECT 'accuracy', a, a, a, n FROM a
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM m
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support)::BIGINT FROM m)
    """,
)
def classification_report(t: Tables) -> DataFrame:
    report = metrics.classification_report(scored(t), "label", "prediction")
    return rounded(report, 6, "precision", "recall", "f1")


@query(
    "auc_exact",
    f"""
    WITH s AS ({SCORED_SQL}), r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s),
    c AS (SELECT count(*) FILTER (label = 1)::DOUBLE AS p, count(*) FILTER (label = 0)::DOUBLE AS n,
          sum(r) FILTER (label = 1) AS x FROM r)
    SELECT round((x - p * (p + 1) / 2) / (p * n), 8) AS auc FROM c
    """,
)
def auc_exact(t: Tables) -> DataFrame:
    return rounded(metrics.roc_auc(scored(t), "label", "score"), 8, "auc")


POINTS_SQL = f"""
    WITH s AS ({SCORED_SQL}), g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY 1),
    c AS (SELECT score, p, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS ps, sum(n) OVER () AS ns
          FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
"""


@query("roc_points", POINTS_SQL + "SELECT score AS threshold, round(fp / ns, 6) AS fpr, round(tp / ps, 6) AS tpr FROM c UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0")
def roc_points(t: Tables) -> DataFrame:
    return rounded(metrics.roc_curve(scored(t), "label", "score"), 6, "fpr", "tpr")


@query(
    "pr_points",
    POINTS_SQL + "SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / ps, 6) AS recall FROM c UNION ALL SELECT NULL, 1.0, 0.0",
)
def pr_points(t: Tables) -> DataFrame:
    return rounded(metrics.precision_recall_curve(scored(t), "label", "score"), 6, "precision", "recall")


@query("average_precision", POINTS_SQL + "SELECT round(sum(p / ps * tp / (tp + fp)), 8) AS average_precision FROM c")
def average_precision(t: Tables) -> DataFrame:
    return rounded(metrics.average_precision(scored(t), "label", "score"), 8, "average_precision")


@query(
    "margin_to_score",
    """
    SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6)
      AS score FROM orders
    """,
)
def margin_to_score(t: Tables) -> DataFrame:
    rows = metrics.scaled_margin(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "score")
    return rounded(rows.drop("o_totalprice"), 6, "score")


@query(
    "soft_vote",
    """
    WITH b AS (SELECT max(o_totalprice) AS top, max(o_custkey) AS last FROM orders),
    v AS (SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INT) AS label,
            (o_totalprice / top + o_custkey / last + (o_orderkey % 10) / 10) / 3 AS s FROM orders, b)
    SELECT row_id, label, round(s, 6) AS score, CAST(s > 0.5 AS DOUBLE) AS prediction FROM v
    """,
)
def soft_vote(t: Tables) -> DataFrame:
    top = t.orders.agg(F.max("o_totalprice")).scalar()
    last = t.orders.agg(F.max("o_custkey")).scalar()
    base = t.orders.select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        "o_totalprice", "o_custkey",
    )
    members = [
        base.withColumn("score", F.col("o_totalprice") / top),
        base.withColumn("score", F.col("o_custkey") / last),
        base.withColumn("score", F.pmod("row_id", F.lit(10)) / 10),
    ]
    return rounded(models.soft_vote(members), 6, "score")


BOARD_SQL = """
    WITH s AS (SELECT l_shipmode AS m, v, CAST(l_returnflag = 'R' AS INT) AS y, CASE l_shipmode WHEN 0 THEN l_quantity > 25
        WHEN 1 THEN l_extendedprice > 30000 ELSE l_discount > 0.03 END AS p
      FROM (SELECT l.*, x.m AS l_shipmode, l_linestatus AS v FROM lineitem l, range(3) x(m))),
    k AS (SELECT m, v, count(*) FILTER (y = 1 AND p) AS tp, count(*) FILTER (y = 1) AS yp, count(*) FILTER (p) AS pp,
        count(*) FILTER ((y = 1) = p) AS ok, count(*) AS n FROM s GROUP BY ALL),
    r AS (SELECT 'rule ' || m AS "Model", v AS "Data Type", round(ok / n, 6) AS "Accuracy", round(tp / pp, 6) AS "Precision",
        round(tp / yp, 6) AS "Recall", round(2 * tp / (pp + yp), 6) AS "F1-Score" FROM k)
"""


def _boards(t: Tables) -> DataFrame:
    rules = [F.col("l_quantity") > 25, F.col("l_extendedprice") > 30000, F.col("l_discount") > 0.03]
    boards = {}
    for status in ("F", "O"):
        rows = None
        part = t.lineitem.where(F.col("l_linestatus") == status).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
        for number, rule in enumerate(rules):
            row = metrics.binary_scores(part.withColumn("p", rule.cast("int")), "y", "p").select(
                F.lit(f"rule {number}").alias("Model"), F.col("accuracy").alias("Accuracy"),
                F.col("precision").alias("Precision"), F.col("recall").alias("Recall"), F.col("f1").alias("F1-Score"),
            )
            rows = row if rows is None else rows.unionByName(row)
        boards[status] = rows
    return rounded(models.combine_boards(boards), 6, "Accuracy", "Precision", "Recall", "F1-Score")


@query("leaderboard_union", BOARD_SQL + "SELECT * FROM r")
def leaderboard_union(t: Tables) -> DataFrame:
    return _boards(t)


@query(
    "best_per_variant",
    BOARD_SQL + """SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY "Data Type" ORDER BY "F1-Score" DESC, "Model") = 1""",
)
def best_per_variant(t: Tables) -> DataFrame:
    return models.best_per_variant(_boards(t))


@query(
    "top3_models",
    BOARD_SQL + """SELECT * FROM r WHERE "Data Type" = 'F' ORDER BY "F1-Score" DESC, "Model" LIMIT 3""",
)
def top3_models(t: Tables) -> DataFrame:
    return models.best_models(_boards(t).where(F.col("Data Type") == "F"), 3)
