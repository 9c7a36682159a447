"""Evaluation tables over predictions derived from the embeddings and labels tables."""

from pyspark.sql import functions as F

from millrace.catalog.q_transform import NEAREST
from millrace.catalog.registry import query, rd, rounded, table
from millrace.functions.scalars import argmax_class
from millrace.operators.clustering import centroid_distances, class_centroids, nearest_centroid
from millrace.operators.evaluation import (
    aupr,
    auroc,
    average_precision,
    averaged_metrics,
    classification_report,
    confusion_matrix,
    log_loss,
    pr_curve,
    roc_curve,
    weighted_metrics,
)


def predictions(spark, d):
    """Class of each embedding and the class of the nearest centre."""
    vectors = table(spark, d, "embeddings")
    centers = class_centroids(vectors, "label", "embedding")
    return nearest_centroid(vectors, centers, "embedding", "prediction").select("vec_id", "label", "prediction")


_PRED = f"{NEAREST}, p AS (SELECT vec_id, label, cluster AS prediction FROM nearest)"
_CLASS = f"""{_PRED},
    k AS (SELECT DISTINCT label AS c FROM p UNION SELECT DISTINCT prediction FROM p),
    r AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS hits,
                 count(*) FILTER (prediction = c) AS predicted, count(*) FILTER (label = c) AS support
          FROM k, p GROUP BY c),
    t AS (SELECT c, hits, support, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
                 CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM r),
    m AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
          FROM t)"""


@query(
    "confusion_matrix",
    f"""WITH {_CLASS} SELECT CAST(a.c AS INT) AS label, CAST(b.c AS INT) AS prediction,
               (SELECT count(*) FROM p WHERE label = a.c AND prediction = b.c) AS n FROM k a, k b""",
)
def confusion(spark, d):
    return confusion_matrix(predictions(spark, d))


_RATES = ("precision", "recall", "f1")


@query(
    "weighted_metrics",
    f"WITH {_CLASS} SELECT {rd('sum(hits) / sum(support)')} AS accuracy, "
    + ", ".join(f"{rd(f'sum({x} * support) / sum(support)')} AS {x}" for x in _RATES)
    + " FROM m",
)
def weighted(spark, d):
    rows = weighted_metrics(predictions(spark, d))
    return rows.select(*[rounded(c).alias(c) for c in rows.columns])


@query(
    "averaged_metrics",
    f"WITH {_CLASS} SELECT 'macro' AS average, "
    + ", ".join(f"{rd(f'avg({x})')} AS {x}" for x in _RATES)
    + " FROM m UNION ALL SELECT 'micro', "
    + ", ".join(rd("sum(hits) / sum(support)") for _ in _RATES)
    + " FROM m UNION ALL SELECT 'weighted', "
    + ", ".join(rd(f"sum({x} * support) / sum(support)") for x in _RATES)
    + " FROM m",
)
def averaged(spark, d):
    return averaged_metrics(predictions(spark, d)).withColumns({c: rounded(c) for c in _RATES})


@query(
    "classification_report",
    f"""WITH {_CLASS}, n AS (SELECT count(*) AS k FROM m)
        SELECT CAST(row_number() OVER (ORDER BY c) - 1 AS INT) AS position, CAST(c AS VARCHAR) AS name,
               {rd('precision', 4)} AS precision, {rd('recall', 4)} AS recall, {rd('f1', 4)} AS f1, support FROM m
        UNION ALL SELECT CAST(any_value(k) AS INT), 'accuracy', NULL, NULL, {rd('sum(hits) / sum(support)', 4)},
               CAST(sum(support) AS BIGINT) FROM m, n
        UNION ALL SELECT CAST(any_value(k) + 1 AS INT), 'macro avg', {', '.join(rd(f'avg({x})', 4) for x in _RATES)},
               CAST(sum(support) AS BIGINT) FROM m, n
        UNION ALL SELECT CAST(any_value(k) + 2 AS INT), 'weighted avg',
               {', '.join(rd(f'sum({x} * support) / sum(support)', 4) for x in _RATES)},
               CAST(sum(support) AS BIGINT) FROM m, n""",
)
def report(spark, d):
    return classification_report(predictions(spark, d))


# Scores with many ties: rounded text length against the quality label.
_SCORED = """s AS (SELECT quality AS label, round(n_chars / 100.0) AS score
                   FROM labels JOIN documents USING (doc_id)),
    tot AS (SELECT sum(label) AS np, count(*) - sum(label) AS nn FROM s),
    g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM s GROUP BY score),
    c AS (SELECT score, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn, np, nn FROM g, tot
          WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def scores(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, d, "documents").select("doc_id", F.round(F.col("n_chars") / 100.0).alias("score"))
    return labels.join(docs, "doc_id")


@query(
    "roc_curve",
    f"""WITH {_SCORED} SELECT score AS threshold, {rd('cn / nn')} AS fpr, {rd('cp / np')} AS tpr FROM c
        UNION ALL SELECT NULL, 0.0, 0.0""",
)
def roc(spark, d):
    return roc_curve(scores(spark, d)).withColumns({"fpr": rounded("fpr"), "tpr": rounded("tpr")})


@query(
    "pr_curve",
    f"""WITH {_SCORED} SELECT score AS threshold, {rd('cp / (cp + cn)')} AS precision, {rd('cp / np')} AS recall FROM c
        UNION ALL SELECT NULL, 1.0, 0.0""",
)
def precision_recall(spark, d):
    return pr_curve(scores(spark, d)).withColumns({"precision": rounded("precision"), "recall": rounded("recall")})


# The chance that a random positive scores above a random negative, ties counting half.
@query(
    "auroc",
    f"""WITH {_SCORED}
        SELECT {rd('sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END * a.p * b.n) / (any_value(np) * any_value(nn))')} AS auroc
        FROM g a, g b, tot""",
)
def area_roc(spark, d):
    return auroc(scores(spark, d)).withColumn("auroc", rounded("auroc"))


@query(
    "aupr",
    f"""WITH {_SCORED},
            pts AS (SELECT score, cp / np AS r, cp / (cp + cn) AS pr FROM c),
            lagged AS (SELECT r, pr, lag(r, 1, 0.0) OVER w AS r0, coalesce(lag(pr) OVER w, pr) AS pr0 FROM pts
                       WINDOW w AS (ORDER BY score DESC))
        SELECT {rd('sum((r - r0) * (pr + pr0) / 2)')} AS aupr FROM lagged""",
)
def area_pr(spark, d):
    return aupr(scores(spark, d)).withColumn("aupr", rounded("aupr"))


@query(
    "average_precision",
    f"""WITH {_SCORED} SELECT {rd('sum(p * cp / (cp + cn)) / any_value(np)')} AS average_precision FROM c""",
)
def step_precision(spark, d):
    return average_precision(scores(spark, d)).withColumn("average_precision", rounded("average_precision"))


# Class probabilities: negative distances through a softmax.
_PROBS = f"""{NEAREST}, z AS (SELECT vec_id, label, k, exp(-d) AS w FROM dist),
    q AS (SELECT vec_id, label, k, w / sum(w) OVER (PARTITION BY vec_id) AS pr FROM z)"""


def probabilities(spark, d):
    vectors = table(spark, d, "embeddings")
    centers = class_centroids(vectors, "label", "embedding")
    weights = vectors.select(
        "vec_id", "label", F.transform(centroid_distances("embedding", centers), lambda x: F.exp(-x)).alias("w")
    )
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    return weights.withColumn("total", total).select(
        "vec_id", "label", F.transform("w", lambda x: x / F.col("total")).alias("probability")
    )


@query("log_loss", f"WITH {_PROBS} SELECT {rd('-avg(ln(pr))')} AS log_loss FROM q WHERE label = k")
def cross_entropy(spark, d):
    return log_loss(probabilities(spark, d)).withColumn("log_loss", rounded("log_loss"))


@query(
    "argmax_class",
    f"WITH {_PROBS} SELECT vec_id, CAST(arg_max(k, pr) AS INT) AS class FROM q GROUP BY vec_id",
)
def best_class(spark, d):
    return probabilities(spark, d).select("vec_id", argmax_class(F.col("probability")).alias("class"))
