"""Five classifiers behind one call, scoring, and prediction export."""

from __future__ import annotations

from collections.abc import Sequence
from time import perf_counter

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import fresh_name, ref
from millrace.operators.evaluation import areas_from, score_points, weighted_metrics
from millrace.session import materialize

# The settings each classifier is trained with.
SETTINGS = {
    "logistic": {"maxIter": 150, "regParam": 0.01, "elasticNetParam": 0.2, "threshold": 0.5},
    "mlp": {"maxIter": 100, "seed": 42},
    "svm": {"maxIter": 100, "regParam": 0.1},
    "tree": {"maxDepth": 12, "minInstancesPerNode": 1, "minInfoGain": 0.0, "impurity": "gini", "seed": 42},
    "forest": {"numTrees": 200, "maxDepth": 12, "featureSubsetStrategy": "auto", "seed": 42},
}
HIDDEN_LAYERS = (20, 10)
SPLIT_SEEDS = {"logistic": 42, "mlp": 42, "svm": 45, "tree": 42, "forest": 42}

# Parts of a training table. Forests draw their bags part by part, so the number is an
# argument and never follows the data or the cluster.
TRAIN_PARTS = 8

_CLASSIFIERS = {
    "logistic": LogisticRegression,
    "mlp": MultilayerPerceptronClassifier,
    "svm": LinearSVC,
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
}


def train(
    kind: str,
    rows: DataFrame,
    features: Sequence[str],
    label: str = "label",
    scale_rows: DataFrame | None = None,
    classes: int = 2,
    invalid: str | None = None,
    **settings,
) -> PipelineModel:
    """Assemble, scale and fit one classifier.

    The scaler learns from the training rows; pass ``scale_rows`` to let it
    learn from others, such as all rows before the split. The logistic model
    scales to 0..1 and skips incomplete rows, the others standardise and fail
    on them, unless ``invalid`` says otherwise.
    """
    if kind not in _CLASSIFIERS:
        raise ValueError(f"unknown classifier {kind!r}")
    invalid = invalid or ("skip" if kind == "logistic" else "error")
    vectors = VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid=invalid)
    if kind == "logistic":
        scaler = MinMaxScaler(inputCol="raw_features", outputCol="features")
    else:
        scaler = StandardScaler(
            inputCol="raw_features", outputCol="features", withMean=True, withStd=True
        )
    options = {**SETTINGS[kind], **settings}
    if kind == "mlp":
        options.setdefault("layers", [len(features), *HIDDEN_LAYERS, classes])
    classifier = _CLASSIFIERS[kind](featuresCol="features", labelCol=label, **options)

    def assembled(df: DataFrame, *extra: str) -> DataFrame:
        # only the features are read, and once
        return vectors.transform(df.select(*[ref(c) for c in [*features, *extra]])).select(
            "raw_features", *[ref(c) for c in extra]
        )

    training = assembled(rows, label)
    fitted = scaler.fit(training if scale_rows is None else assembled(scale_rows))
    model = classifier.fit(fitted.transform(training).select("features", ref(label)))
    return PipelineModel([vectors, fitted, model])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with prediction, raw scores and, where the model has them, probabilities."""
    return model.transform(df).drop("raw_features", "features")


def positive_score(scored: DataFrame) -> Column:
    """Score of class 1: its probability, or the raw margin where there is none."""
    name = "probability" if "probability" in scored.columns else "rawPrediction"
    return F.get(vector_to_array(F.col(name)), F.lit(1))


def dealt(rows: DataFrame, parts: int = TRAIN_PARTS) -> DataFrame:
    """Training rows in ``parts`` parts by their content, each in a fixed order.

    The same rows give the same parts on any cluster and from any storage; set ``parts`` to
    the cores of the cluster for large tables. Equal rows are counted, not gathered: copy
    number ``j`` of a row goes to the part ``j`` behind that of its hash, so no part gets
    more of the copies than others, whatever their number.
    """
    columns = [ref(c) for c in rows.columns]
    n, first = fresh_name(rows, "__n"), fresh_name(rows, "__part")
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))
    # Of c copies a part gets c / parts, rounded up for the first c % parts of them.
    turn = F.explode(F.sequence(F.lit(0), F.least(ref(n), F.lit(parts)).cast("int") - 1))
    shares = counted.select(*columns, ref(n), F.pmod(F.xxhash64(*columns), F.lit(parts)).alias(first), turn.alias(f"{first}j"))
    own = F.floor((ref(n) - ref(f"{first}j") - 1) / parts) + 1
    placed = shares.select(*columns, own.cast("int").alias(n), ((ref(first) + ref(f"{first}j")) % parts).cast("int").alias(first))
    at_home = placed.repartitionById(parts, ref(first))
    copies = at_home.select(*columns, F.explode(F.sequence(F.lit(1), ref(n))).alias(n)).select(*columns)
    return copies.sortWithinPartitions(*columns)


def evaluate(
    kind: str,
    train_rows: DataFrame,
    test_rows: DataFrame,
    features: Sequence[str],
    label: str = "label",
    classes: int = 2,
    parts: int = TRAIN_PARTS,
    **settings,
) -> tuple[dict, DataFrame, DataFrame | None, PipelineModel]:
    """Train, score and measure one classifier.

    Returns the result row, the stored test rows ``(label, prediction,
    probability, score)``, for two classes their score points, and the model. The
    training rows are read several times, so they should come from a stored table.
    """
    begin = perf_counter()
    rows = dealt(train_rows.select(*[ref(c) for c in [*features, label]]), parts)
    model = train(kind, rows, features, label, classes=classes, **settings)
    trained = perf_counter()
    scored = predict(model, test_rows)
    probability = F.lit(None).cast("array<double>")
    if "probability" in scored.columns:
        probability = vector_to_array(F.col("probability"))
    tested = materialize(
        scored.select(
            ref(label).alias("label"),
            "prediction",
            probability.alias("probability"),
            positive_score(scored).alias("score"),
        ),
        "scored-rows",
    )
    predicted = perf_counter()
    row = {"model": kind, "train_seconds": trained - begin, "predict_seconds": predicted - trained}
    row |= weighted_metrics(tested).first().asDict()
    points = score_points(tested) if classes == 2 else None
    if points is not None:
        row |= areas_from(points).first().asDict()
    return row, tested, points, model


def linear_score(
    df: DataFrame, weights: dict[str, float], intercept: float, threshold: float = 0.5
) -> DataFrame:
    """Add ``margin``, ``probability`` and ``prediction`` of a given linear model.

    Class 1 where the logistic probability is above the threshold; a tie gives 0.
    """
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + F.lit(float(weight)) * ref(name).cast("double")
    return (
        df.withColumn("margin", margin)
        .withColumn("probability", 1.0 / (1.0 + F.exp(-F.col("margin"))))
        .withColumn("prediction", F.when(F.col("probability") > threshold, 1.0).otherwise(0.0))
    )


def export_predictions(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(True_Label, Predicted_Label, Probability_Class_1)``; no vector gives null."""
    probability = ref("probability")
    if df.schema["probability"].dataType.typeName() not in ("double", "array"):
        probability = vector_to_array(probability)
    if df.schema["probability"].dataType.typeName() != "double":
        probability = F.get(probability, F.lit(1))
    return df.select(
        ref(label).alias("True_Label"),
        ref(prediction).alias("Predicted_Label"),
        probability.alias("Probability_Class_1"),
    )


def linear_terms(model: PipelineModel) -> tuple[list[float], float]:
    """Coefficients and intercept of a fitted linear model."""
    last = model.stages[-1]
    return [float(x) for x in last.coefficients], float(last.intercept)


def feature_weights(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """``(feature, weight)``: coefficients of a linear model on the scaled features, with the
    intercept under a null name, or the importances of a tree or forest. Empty for others."""
    fitted = model.stages[-1]
    rows: list[tuple[str | None, float]] = []
    if hasattr(fitted, "featureImportances"):
        rows = list(zip(features, map(float, fitted.featureImportances.toArray())))
    elif hasattr(fitted, "coefficients"):
        rows = [*zip(features, map(float, fitted.coefficients.toArray())), (None, float(fitted.intercept))]
    return spark.createDataFrame(rows, "feature string, weight double")
