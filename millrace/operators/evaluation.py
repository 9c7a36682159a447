"""Evaluation tables, all as aggregations over ``(label, prediction, score)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.operators.distribution import running_totals
from millrace.session import materialize

# Fixed value: class probabilities are kept this far from 0 and 1.
PROBABILITY_FLOOR = 1e-7

RESULT_FIELDS = ("accuracy", "precision", "recall", "f1", "auroc", "aupr", "train_seconds", "predict_seconds")


def _counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        ref(label).cast("int").alias("label"), ref(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` over all classes seen on either side, zeros included."""
    counts = _counts(df, label, prediction)
    # reading n keeps both uses of the counts alike, so they are computed once
    seen = F.array_sort(
        F.array_union(*[F.collect_set(F.when(F.col("n") > 0, F.col(c))) for c in ("label", "prediction")])
    )
    cells = (
        counts.agg(seen.alias("classes"))
        .select("classes", F.explode("classes").alias("label"))
        .select("label", F.explode("classes").alias("prediction"))
    )
    return cells.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, hits, predicted, support, precision, recall, f1)``; zero division gives 0."""
    n, same = F.col("n"), F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col("label").alias("class"), n.alias("support"), zero.alias("predicted"),
        F.when(same, n).otherwise(zero).alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")
    )
    sums = (
        _counts(df, label, prediction)
        .select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "predicted", "support")])
    )
    rated = sums.withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", _ratio(2 * p * r, p + r))


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.sum("support")


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1."""
    return per_class(df, label, prediction).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[_weighted(m).alias(m) for m in ("precision", "recall", "f1")],
    )


_RATES = ("precision", "recall", "f1")


def averaged_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(average, precision, recall, f1)`` for macro, micro and weighted averages."""
    hits = F.sum("hits") / F.sum("support")
    one = per_class(df, label, prediction).agg(
        F.struct(F.lit("macro").alias("average"), *[F.avg(m).alias(m) for m in _RATES]).alias("macro"),
        F.struct(F.lit("micro").alias("average"), *[hits.alias(m) for m in _RATES]).alias("micro"),
        F.struct(F.lit("weighted").alias("average"), *[_weighted(m).alias(m) for m in _RATES]).alias(
            "weighted"
        ),
    )
    return one.select(F.inline(F.array("macro", "micro", "weighted")))


def classification_report(
    df: DataFrame,
    names: Sequence[str] | None = None,
    label: str = "label",
    prediction: str = "prediction",
    digits: int = 4,
) -> DataFrame:
    """``(position, name, precision, recall, f1, support)``: classes in order, then accuracy,
    macro average and weighted average."""
    classes = per_class(df, label, prediction)
    if names is None:
        name = F.col("class").cast("string")
    else:
        name = F.coalesce(
            F.get(F.array(*[F.lit(n) for n in names]), F.col("class")), F.col("class").cast("string")
        )
    rows = F.array_sort(
        F.collect_list(F.struct("class", name.alias("name"), *_RATES, "support"))
    )
    total, blank = F.sum("support"), F.lit(None).cast("double")
    accuracy = F.sum("hits") / total
    whole = classes.agg(
        rows.alias("rows"),
        F.struct(
            F.lit("accuracy").alias("name"), blank.alias("precision"), blank.alias("recall"),
            accuracy.alias("f1"), total.alias("support"),
        ).alias("accuracy"),
        F.struct(
            F.lit("macro avg").alias("name"), *[F.avg(m).alias(m) for m in _RATES], total.alias("support")
        ).alias("macro"),
        F.struct(
            F.lit("weighted avg").alias("name"), *[_weighted(m).alias(m) for m in _RATES],
            total.alias("support"),
        ).alias("weighted"),
    )
    lines = F.concat(
        F.transform(
            "rows", lambda r: F.struct(r["name"].alias("name"), *[r[m].alias(m) for m in _RATES], r["support"].alias("support"))
        ),
        F.array("accuracy", "macro", "weighted"),
    )
    return whole.select(F.posexplode(lines).alias("position", "line")).select(
        "position",
        F.col("line.name").alias("name"),
        *[F.round(F.col("line")[m], digits).alias(m) for m in _RATES],
        F.col("line.support").alias("support"),
    )


def report_text(report: DataFrame, digits: int = 4) -> str:
    """The report as aligned text: classes, blank line, averages. One line per class."""
    rows = report.orderBy("position").collect()
    width = max([len("weighted avg"), *[len(r["name"]) for r in rows]])
    heads = "".join(f" {h:>9}" for h in ("precision", "recall", "f1-score", "support"))
    lines = [" " * (width + 1) + heads, ""]
    for r in rows:
        if r["name"] == "accuracy":
            lines.append("")
        rates = "".join(" " * 10 if r[m] is None else f" {r[m]:>9.{digits}f}" for m in _RATES)
        lines.append(f"{r['name']:>{width}} {rates} {r['support']:>9}")
    return "\n".join(lines) + "\n"


def score_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per score: positives ``p``, negatives ``n``, their running totals ``cum_p``,
    ``cum_n`` from the highest score down, and the overall totals ``all_p``, ``all_n``,
    which are null unless the labels are 0 and 1. Rows with a null or NaN score are left out."""
    y, known = ref(label), ref(score).cast("double")
    rows = df.filter(y.isNotNull() & known.isNotNull() & ~F.isnan(known)).select(
        ref(score).cast("double").alias("score"),
        F.when(y == 1, 1).otherwise(0).alias("p"),
        F.when(y == 0, 1).otherwise(0).alias("n"),
        F.when(y.isin(0, 1), 0).otherwise(1).alias("other"),
    )
    # one row per score, stored: the input is evaluated once, however costly it is
    counts = rows.groupBy("score").agg(*[F.sum(c).alias(c) for c in ("p", "n", "other")])
    points, total = running_totals(
        materialize(counts, "score-counts"), "score", ["p", "n", "other"], descending=True
    )
    binary = total["p"] and total["n"] and not total["other"]
    return points.select(
        "score", "p", "n", "cum_p", "cum_n",
        F.lit(total["p"] if binary else None).cast("bigint").alias("all_p"),
        F.lit(total["n"] if binary else None).cast("bigint").alias("all_n"),
    )


def roc_from(points: DataFrame) -> DataFrame:
    """``(threshold, fpr, tpr)`` of score points, and the origin with null threshold."""
    origin = points.sparkSession.createDataFrame(
        [(None, 0.0, 0.0)], "threshold double, fpr double, tpr double"
    )
    return points.select(
        F.col("score").alias("threshold"),
        (F.col("cum_n") / F.col("all_n")).alias("fpr"),
        (F.col("cum_p") / F.col("all_p")).alias("tpr"),
    ).unionByName(origin)


def pr_from(points: DataFrame) -> DataFrame:
    """``(threshold, precision, recall)`` of score points, and the end point (precision 1,
    recall 0) with null threshold."""
    end = points.sparkSession.createDataFrame(
        [(None, 1.0, 0.0)], "threshold double, precision double, recall double"
    )
    return points.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_p"), F.col("cum_p") + F.col("cum_n")).alias("precision"),
        (F.col("cum_p") / F.col("all_p")).alias("recall"),
    ).unionByName(end)


def areas_from(points: DataFrame) -> DataFrame:
    """One row ``(auroc, aupr, average_precision)`` of score points.

    ``auroc`` counts ties half, ``aupr`` sums trapezoids and starts level with
    the first point, ``average_precision`` weights precision by recall gained.
    """
    p, n, cum_p, cum_n = (F.col(c) for c in ("p", "n", "cum_p", "cum_n"))
    all_p, all_n = F.max("all_p"), F.max("all_n")
    below = F.col("all_n") - cum_n + n / 2
    here = F.try_divide(cum_p, cum_p + cum_n)
    past = F.coalesce(F.try_divide(cum_p - p, cum_p - p + cum_n - n), here)
    return points.agg(
        (F.sum(p * below) / (all_p.cast("double") * all_n)).alias("auroc"),
        (F.sum(p * (here + past) / 2) / all_p).alias("aupr"),
        (F.sum(p * here) / all_p).alias("average_precision"),
    )


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC points for every distinct score."""
    return roc_from(score_points(df, label, score))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision-recall points for every distinct score."""
    return pr_from(score_points(df, label, score))


def areas(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row ``(auroc, aupr, average_precision)``."""
    return areas_from(score_points(df, label, score))


def auroc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve; null unless the labels are 0 and 1."""
    return areas(df, label, score).select("auroc")


def aupr(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the precision-recall curve by trapezoids."""
    return areas(df, label, score).select("aupr")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision weighted by the recall gained at every score."""
    return areas(df, label, score).select("average_precision")


def log_loss(df: DataFrame, label: str = "label", scores: str = "probability") -> DataFrame:
    """Mean negative log probability of the true class; fails on a label without a score."""
    y = ref(label).cast("int")
    p = F.when(
        y.isNotNull() & ref(scores).isNotNull() & ((y < 0) | (y >= F.size(ref(scores)))),
        F.raise_error(F.concat(F.lit("no score for label "), y.cast("string"))).cast("double"),
    ).otherwise(F.get(ref(scores), y))
    kept = F.greatest(F.least(p, F.lit(1.0 - PROBABILITY_FLOOR)), F.lit(PROBABILITY_FLOOR))
    return df.agg((-F.avg(F.ln(kept))).alias("log_loss"))


def results_table(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """One row per model: name, metrics, seconds. Missing metrics are null."""
    data = [
        (r["model"], *[None if r.get(f) is None else float(r[f]) for f in RESULT_FIELDS]) for r in rows
    ]
    return spark.createDataFrame(data, "model string, " + ", ".join(f"{f} double" for f in RESULT_FIELDS))
