"""Labels, splits, classifiers. The target is text length, the features other counts on the text."""

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.catalog.registry import (
    DOC_FEATURES,
    ORDERS_GAPS,
    doc_features,
    orders_gaps,
    query,
    rd,
    rounded,
    table,
    unit_hash_sql,
    view_query,
)
from millrace.functions.columns import find_target, select_features
from millrace.operators.binning import quantile_bins
from millrace.operators.evaluation import results_table
from millrace.operators.labeling import (
    TRAIN_TEST,
    TRAIN_VALIDATION_TEST,
    label_above_mean,
    label_above_mean_sql,
    label_from_bin,
    split_number,
    split_rows,
)
from millrace.operators.models import SPLIT_SEEDS, evaluate, export_predictions, linear_score, predict
from millrace.session import materialize


@query(
    "label_above_mean",
    f"""WITH g AS ({ORDERS_GAPS})
        SELECT o_orderkey, CAST(o_totalprice >= (SELECT avg(o_totalprice) FROM g) AS INT) AS label
        FROM g WHERE o_totalprice IS NOT NULL""",
)
def labelled(spark, d):
    orders = orders_gaps(spark, d)
    target = find_target(orders, ["not_there"], contains="totalprice")
    return label_above_mean(orders, target).select("o_orderkey", "label")


@query(
    "label_above_mean_sql",
    f"""WITH g AS ({ORDERS_GAPS})
        SELECT o_orderkey, CASE WHEN o_totalprice >= (SELECT avg(o_totalprice) FROM g) THEN 1 ELSE 0 END AS label
        FROM g""",
)
def labelled_sql(spark, d):
    return label_above_mean_sql(orders_gaps(spark, d), "o_totalprice").select("o_orderkey", "label")


@query(
    "split_two_way",
    f"SELECT o_orderkey, CASE WHEN {unit_hash_sql('o_orderkey')} < 0.8 THEN 0 ELSE 1 END AS part FROM orders",
)
def two_way(spark, d):
    return split_number(table(spark, d, "orders").select("o_orderkey"), TRAIN_TEST, "o_orderkey", out="part")


@query(
    "split_three_way",
    f"""SELECT CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS part,
               count(*) AS n, {rd('sum(o_totalprice)', 1)} AS total
        FROM (SELECT {unit_hash_sql('o_orderkey')} AS u, o_totalprice FROM orders) GROUP BY 1""",
)
def three_way(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    parts = split_rows(orders, TRAIN_VALIDATION_TEST, key="o_orderkey")
    named = [
        p.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 1).alias("total"))
        for n, p in zip(("train", "validation", "test"), parts)
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


_WEIGHTS = {"n_words": 0.01, "n_lines": -0.05, "n_digits": 0.002}
_LINEAR = f"""WITH g AS ({DOC_FEATURES}),
    z AS (SELECT doc_id, n_chars, -1.5 + 0.01 * n_words - 0.05 * n_lines + 0.002 * n_digits AS margin FROM g),
    s AS (SELECT doc_id, n_chars, margin, 1 / (1 + exp(-margin)) AS p FROM z)"""


@query(
    "linear_score",
    f"""{_LINEAR} SELECT doc_id, {rd('margin')} AS margin, {rd('p')} AS probability,
               CAST(p > 0.5 AS DOUBLE) AS prediction FROM s""",
)
def linear(spark, d):
    rows = linear_score(doc_features(spark, d), _WEIGHTS, -1.5)
    return rows.select(
        "doc_id", rounded("margin").alias("margin"), rounded("probability").alias("probability"), "prediction"
    )


@query(
    "predictions_export",
    f"""{_LINEAR} SELECT CAST(n_chars >= (SELECT avg(n_chars) FROM s) AS INT) AS "True_Label",
               CAST(p > 0.5 AS DOUBLE) AS "Predicted_Label", {rd('p')} AS "Probability_Class_1"
        FROM s""",
)
def exported(spark, d):
    rows = linear_score(label_above_mean(doc_features(spark, d), "n_chars"), _WEIGHTS, -1.5)
    return export_predictions(rows).withColumn("Probability_Class_1", rounded("Probability_Class_1"))


def model_rows(spark, d, classes=2):
    """Labelled feature rows, written down once so that no model reads the texts again."""
    rows = doc_features(spark, d)
    if classes > 2:
        rows = label_from_bin(quantile_bins(rows, ["n_chars"], classes), "n_chars_quantile")
    else:
        rows = label_above_mean(rows, "n_chars")
    return materialize(rows, "model-rows")


def fitted(rows, kind, classes=2):
    features = [c for c in select_features(rows, "n_chars") if c not in ("doc_id", "label")]
    train, test = split_rows(rows, TRAIN_TEST, key="doc_id", seed=SPLIT_SEEDS[kind])
    return evaluate(kind, train, test, features, classes=classes), test, features


def both_ways(model, rows, features):
    """Rows with the prediction of a linear model and, as ``by_hand``, that of its coefficients;
    the rows are read once."""
    scaled = PipelineModel(model.stages[:2]).transform(rows)
    linear = model.stages[-1]
    told = linear.transform(scaled).withColumnsRenamed({"prediction": "theirs", "probability": "their_probability"})
    at = [F.get(vector_to_array("features"), F.lit(i)).alias(c) for i, c in enumerate(features)]
    kept = [c for c in told.columns if c not in {*features, "features", "raw_features"}]
    flat = told.select(*kept, *at)
    ours = linear_score(flat, dict(zip(features, map(float, linear.coefficients))), float(linear.intercept))
    return ours.withColumnRenamed("prediction", "by_hand")


def disagreements(model, test, features):
    """Test rows for which the fitted coefficients, applied by hand, give another class."""
    return both_ways(model, test, features).filter(F.col("by_hand") != F.col("theirs")).count()


def checked(kind, row, tested, n_odd=0, learnt=None):
    """Supports of the classes on the test rows, and what must hold of any sound model:
    probabilities sum to 1, it beats naming the largest class, no two ways to score differ.
    Given scored training rows as ``learnt``, it has to beat the largest class on these."""
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    share = tested.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    if learnt is None:
        right, most = row["accuracy"], share.agg(F.max("n") / F.sum("n")).first()[0]
    else:
        by_class = learnt.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("hits"))
        right, most = by_class.agg(F.sum("hits") / F.sum("n"), F.max("n") / F.sum("n")).first()
    sums = tested.filter(F.abs(total - 1.0) > 1e-9).count()
    return share.select(
        F.lit(kind).alias("model"), F.col("label").cast("int").alias("label"), F.col("n").alias("support"),
        F.lit(sums == 0).alias("sums_to_one"), F.lit(bool(right > most)).alias("beats_majority"),
        F.lit(n_odd).cast("bigint").alias("disagreements"),
    )


def support_sql(kind, label, seed):
    return f"""WITH g AS ({DOC_FEATURES}), l AS (SELECT doc_id, {label} AS label FROM g)
        SELECT '{kind}' AS model, label, count(*) AS support, true AS sums_to_one, true AS beats_majority,
               CAST(0 AS BIGINT) AS disagreements
        FROM l WHERE {unit_hash_sql('doc_id', seed)} >= 0.8 GROUP BY label"""


def _train(kind):
    def run(spark, d):
        (row, tested, _, model), test, features = fitted(model_rows(spark, d), kind)
        odd = disagreements(model, test, features) if kind in ("logistic", "svm") else 0
        return checked(kind, row, tested, odd)

    return run


_ABOVE = "CAST(n_chars >= (SELECT avg(n_chars) FROM g) AS INT)"
for _kind in ("logistic", "mlp", "svm", "tree", "forest"):
    query(f"train_{_kind}", support_sql(_kind, _ABOVE, SPLIT_SEEDS[_kind]))(_train(_kind))


@query("train_tree_classes")
def tree_classes(spark, d):
    """Five classes from quantile bins; no area under the curve."""
    (row, *_), _, _ = fitted(model_rows(spark, d, 5), "tree", 5)
    return results_table(spark, [row])


@query(
    "train_forest_wide",
    f"""SELECT 'forest' AS model, CAST(label >= 5 AS INT) AS label, count(*) AS support, true AS sums_to_one,
               true AS beats_majority, CAST(0 AS BIGINT) AS disagreements
        FROM embeddings WHERE {unit_hash_sql('vec_id')} >= 0.8 GROUP BY 2""",
)
def wide_forest(spark, d):
    """64 features, the lower against the upper half of the classes.

    The tables draw classes and vectors apart, so unseen rows tell nothing of the fit: that it
    beats naming the largest class is judged on the rows it learnt from.
    """
    vectors = table(spark, d, "embeddings")
    features = [f"e{i}" for i in range(64)]
    rows = vectors.select(
        "vec_id",
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(features)],
    )
    train, test = split_rows(materialize(rows, "model-rows"), TRAIN_TEST, key="vec_id")
    row, tested, _, model = evaluate("forest", train, test, features)
    odd = tested.filter(F.col("prediction") != F.array_position("probability", F.array_max("probability")) - 1).count()
    return checked("forest", row, tested, odd, learnt=predict(model, train))


# A table the model has not seen: coefficients learnt on documents score pages; each prediction
# is also worked out from the coefficients.
@query(
    "score_new_table",
    "SELECT page_id, true AS agrees, true AS probability_agrees FROM pages",
)
def score_new(spark, d):
    (_, _, _, model), _, features = fitted(model_rows(spark, d), "logistic")
    pages = view_query(
        spark, d,
        """SELECT page_id, CAST(length(html) - length(replace(html, ' ', '')) + 1 AS DOUBLE) AS n_words,
                  CAST(length(html) - length(replace(html, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
                  CAST(regexp_count(html, '[0-9]') AS DOUBLE) AS n_digits FROM pages""",
        "pages",
    )
    scored = both_ways(model, pages, features)
    theirs = F.get(vector_to_array("their_probability"), F.lit(1))
    # predict() and the model's last stage are the same call.
    by_call = predict(model, pages).select("page_id", F.col("prediction").alias("called"))
    return scored.join(by_call, "page_id").select(
        "page_id", ((F.col("by_hand") == F.col("theirs")) & (F.col("called") == F.col("theirs"))).alias("agrees"),
        (F.abs(theirs - F.col("probability")) < 1e-9).alias("probability_agrees"),
    )


@query(
    "model_results_table",
    "SELECT unnest(['forest', 'logistic', 'mlp', 'svm', 'tree']) AS model, true AS accuracy_holds, true AS in_range, true AS timed",
)
def results(spark, d):
    """The accuracy in the table is the share of test rows that were predicted right."""
    rows = model_rows(spark, d)
    kept, again = [], []
    for kind in ("logistic", "mlp", "svm", "tree", "forest"):
        (row, tested, *_), _, _ = fitted(rows, kind)
        kept.append(row)
        again.append((kind, tested.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]))
    out = results_table(spark, kept).join(spark.createDataFrame(again, "model string, again double"), "model")
    rates = [F.col(c).between(0.0, 1.0) for c in ("accuracy", "precision", "recall", "f1", "auroc", "aupr")]
    return out.select(
        "model", (F.abs(F.col("accuracy") - F.col("again")) < 1e-12).alias("accuracy_holds"),
        reduce(lambda a, b: a & b, rates).alias("in_range"),
        ((F.col("train_seconds") > 0) & (F.col("predict_seconds") > 0)).alias("timed"),
    )
