"""Labels, splits, classifiers and evaluation."""

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from millrace.operators import evaluation as E
from millrace.operators import labeling as L
from millrace.operators import models as M
from millrace.plans.supervised import experiment


def test_label_policies(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (2.0,)], "t double")
    assert sorted(r["label"] for r in L.label_above_mean(df, "t").collect()) == [0, 1, 1]
    zero = L.label_above_mean(df, "t", "zero").filter("t is null").first()
    assert zero["label"] == 0
    assert sorted(r["label"] for r in L.label_above_mean_sql(df, "t").collect()) == [0, 0, 1, 1]
    with pytest.raises(ValueError):
        L.label_above_mean(df, "t", "what")


def test_sql_label_quotes_names(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "`PER%` double")
    assert sorted(r["label"] for r in L.label_above_mean_sql(df, "PER%").collect()) == [0, 1]


@pytest.mark.parametrize("parts", [1, 5])
def test_split_is_disjoint_complete_and_stable(spark, parts):
    df = spark.range(0, 4000, 1, parts)
    split = [{r[0] for r in p.collect()} for p in L.split_rows(df, (0.7, 0.15, 0.15), "id")]
    assert sum(map(len, split)) == 4000 and len(set().union(*split)) == 4000
    assert [abs(len(s) / 4000 - w) < 0.03 for s, w in zip(split, (0.7, 0.15, 0.15))] == [True] * 3
    again = [{r[0] for r in p.collect()} for p in L.split_rows(spark.range(4000), (0.7, 0.15, 0.15), "id")]
    assert split == again
    assert split[0] != {r[0] for r in L.split_rows(df, (0.7, 0.15, 0.15), "id", seed=1)[0].collect()}


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        y = int(rng.random() < 0.3)
        rows.append((y, round(rng.gauss(y, 1.2), 1), float(rng.random() < 0.2 + 0.5 * y)))
    return spark.createDataFrame(rows, "label int, score double, prediction double").repartition(4).cache()


def test_areas_equal_the_built_in(scored):
    for name, ours in (("areaUnderROC", E.auroc), ("areaUnderPR", E.aupr)):
        want = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=name, numBins=0).evaluate(scored)
        assert ours(scored).first()[0] == pytest.approx(want, abs=1e-12)


def test_weighted_metrics_equal_the_built_in(scored):
    row = E.weighted_metrics(scored).first()
    for ours, theirs in (
        ("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1"),
    ):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored))


def test_curves_run_from_corner_to_corner(scored):
    roc = E.roc_curve(scored).orderBy(F.desc_nulls_first("threshold")).collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(roc, roc[1:]))
    pr = E.pr_curve(scored).orderBy(F.desc_nulls_first("threshold")).collect()
    assert (pr[0]["precision"], pr[0]["recall"]) == (1.0, 0.0) and pr[-1]["recall"] == 1.0
    steps = sum((b["recall"] - a["recall"]) * b["precision"] for a, b in zip(pr, pr[1:]))
    assert E.average_precision(scored).first()[0] == pytest.approx(steps)


def test_areas_need_two_classes(spark):
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    three = spark.createDataFrame([(0, 0.1), (1, 0.5), (2, 0.7)], "label int, score double")
    for df in (one, three):
        assert E.auroc(df).first()[0] is None
        assert E.aupr(df).first()[0] is None


def test_report_on_published_class_counts(spark):
    # Class rows of a known report (precision, recall, F1, support).
    known = [
        (0.9874, 0.9672, 0.9772, 244), (0.9277, 0.9776, 0.9520, 223), (0.9913, 0.9620, 0.9764, 237),
        (0.9136, 0.9526, 0.9327, 211), (0.9597, 0.9261, 0.9426, 257),
    ]
    hits = [round(r * s) for _, r, _, s in known]
    predicted = [round(h / p) for h, (p, _, _, _) in zip(hits, known)]
    missed = [s - h for h, (_, _, _, s) in zip(hits, known)]
    wrong = [p - h for p, h in zip(predicted, hits)]
    # Any table of misses with these row and column sums gives the same report.
    rows = [(c, float(c)) for c in range(5) for _ in range(hits[c])]
    left = list(wrong)
    for c in sorted(range(5), key=lambda c: -missed[c]):
        for _ in range(missed[c]):
            to = max((k for k in range(5) if k != c), key=lambda k: left[k])
            left[to] -= 1
            rows.append((c, float(to)))
    assert left == [0] * 5
    df = spark.createDataFrame(rows, "label int, prediction double")
    report = E.classification_report(df).orderBy("position").collect()
    for r, (p, rec, f1, s) in zip(report, known):
        assert (r["precision"], r["recall"], r["f1"], r["support"]) == (p, rec, f1, s)
    tail = [(r["name"], r["precision"], r["recall"], r["f1"], r["support"]) for r in report[5:]]
    assert tail == [
        ("accuracy", None, None, 0.9565, 1172),
        ("macro avg", 0.9559, 0.9571, 0.9562, 1172),
        ("weighted avg", 0.9575, 0.9565, 0.9566, 1172),
    ]
    lines = E.report_text(E.classification_report(df)).split("\n")
    assert lines[0] == "              precision    recall  f1-score   support"
    assert lines[2] == "           0     0.9874    0.9672    0.9772       244"
    assert lines[8] == "    accuracy                         0.9565      1172"
    assert lines[10] == "weighted avg     0.9575    0.9565    0.9566      1172"


def test_report_uses_names_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0), (0, 2.0)], "label int, prediction double")
    rows = {r["name"]: r for r in E.classification_report(df, ["low", "high"]).collect()}
    assert rows["high"]["precision"] == 0.0 and rows["high"]["f1"] == 0.0
    assert rows["2"]["support"] == 0 and rows["low"]["support"] == 2
    cells = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[1, 1] == 0 and sum(cells.values()) == 3


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0])], "label int, probability array<double>")
    want = -(math.log(1 - 1e-7) + math.log(1e-7)) / 2
    assert E.log_loss(df).first()[0] == pytest.approx(want)


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(21)
    rows = []
    for i in range(600):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b, 3 * a - 2 * b + 1))
    df = spark.createDataFrame(rows, "id int, a double, b double, PER double")
    return df.withColumn("PER_minmax", F.col("PER") / 10).cache()


@pytest.mark.parametrize(
    "kind,floor,settings",
    [("logistic", 0.93, {}), ("svm", 0.9, {}), ("mlp", 0.93, {}), ("tree", 0.85, {}), ("forest", 0.85, {"numTrees": 20})],
)
def test_classifiers_learn(separable, kind, floor, settings):
    out = experiment(separable, kind, key="id", **settings)
    row = out.results.first()
    assert row["accuracy"] > floor and row["auroc"] > floor
    assert row["train_seconds"] > 0 and row["predict_seconds"] > 0
    assert sum(r["n"] for r in out.confusion.collect()) == out.predictions.count()
    assert out.predictions.columns == ["True_Label", "Predicted_Label", "Probability_Class_1"]


def test_same_seed_same_predictions(separable):
    def run():
        return sorted(map(tuple, experiment(separable, "tree", key="id").predictions.collect()))

    assert run() == run()


def test_leaky_features_only_on_request(separable):
    assert experiment(separable, "tree", key="id", drop_derived=False).results.first()["accuracy"] > 0.98


def test_five_classes_have_no_area(spark, separable, tmp_path):
    from millrace.operators.binning import quantile_bins

    binned = quantile_bins(separable.drop("PER_minmax"), ["PER"])
    out = experiment(binned, "tree", targets=("PER_quantile",), key="id", fit_on="all")
    row = out.results.first()
    assert row["auroc"] is None and out.roc is None and row["accuracy"] > 0.5
    assert out.report.count() == 8
    out.write(str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out" / "report"), header=True)
    assert back.count() == 8
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out" / "report_text")).collect()]
    assert len(lines) == 11 and "f1-score" in lines[0] and "weighted avg" in lines[-1]


def test_linear_score_equals_the_fitted_model(separable):
    rows = L.label_above_mean(separable, "PER")
    model = M.train("logistic", rows, ["a", "b"], elasticNetParam=0.0)
    weights, intercept = M.linear_terms(model)
    lo, hi = model.stages[1].originalMin, model.stages[1].originalMax
    scaled = rows.select(
        "id", *[((F.col(c) - float(lo[i])) / float(hi[i] - lo[i])).alias(c) for i, c in enumerate(("a", "b"))]
    )
    ours = M.linear_score(scaled, dict(zip(("a", "b"), weights)), intercept)
    got = {r["id"]: (r["prediction"], r["probability"]) for r in ours.collect()}
    fitted = M.predict(model, rows)
    for r in fitted.select("id", "prediction", M.positive_score(fitted).alias("p")).collect():
        assert got[r["id"]] == (r["prediction"], pytest.approx(r["p"], abs=1e-9))


def test_tie_gives_class_zero(spark):
    df = spark.createDataFrame([(0.0,), (1e-9,)], "x double")
    assert [r["prediction"] for r in M.linear_score(df, {"x": 1.0}, 0.0).collect()] == [0.0, 1.0]


def test_a_forest_does_not_depend_on_the_storage(spark):
    rows = spark.range(600).select(
        (F.col("id") % 37).cast("double").alias("a"), (F.col("id") * 7 % 53).cast("double").alias("b"),
        ((F.col("id") % 37 + F.col("id") * 7 % 53) > 40).cast("int").alias("label"),
    )
    fits = [
        M.evaluate("forest", rows.repartition(n), rows.coalesce(1), ["a", "b"], numTrees=5, maxDepth=4) for n in (2, 8)
    ]
    a, b = (sorted((r["label"], tuple(r["probability"])) for r in f[1].collect()) for f in fits)
    assert a == b
    assert M.dealt(rows, 3).rdd.getNumPartitions() == 3 and M.dealt(rows, 3).count() == 600


@pytest.mark.parametrize("parts", [3, 8])
def test_copies_are_dealt_evenly(spark, parts):
    hot = [(1.0, 2.0, 1)] * 4_000
    rows = hot + [(float(i), float(i % 7), i % 2) for i in range(4_000)] + [(None, float("nan"), 0)] * 5
    df = spark.createDataFrame(rows, "a double, b double, label int").repartition(5)
    out = M.dealt(df, parts).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("part").count().collect()]
    assert len(sizes) == parts and sum(sizes) == len(rows) and max(sizes) <= 1.2 * len(rows) / parts
    of_hot = [r["count"] for r in out.filter("a = 1 and b = 2").groupBy("part").count().collect()]
    assert max(of_hot) - min(of_hot) <= 1
    again = M.dealt(df.repartition(2), parts).withColumn("part", F.spark_partition_id())
    held = lambda d: sorted(map(str, d.collect()))
    assert held(out) == held(again) and M.dealt(df.limit(0), parts).count() == 0


def test_an_experiment_keeps_its_model(spark, tmp_path):
    rows = spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("PER"), (F.col("id") % 20 + F.col("id") % 3).cast("double").alias("x"),
        (F.col("id") % 20 * 2).cast("double").alias("PER_minmax"), (F.col("id") % 7).cast("double").alias("PER_game"),
    )
    out = experiment(rows, "logistic", target="PER", key="id")
    assert set(out.features) == {"x", "PER_game"}
    assert [r["feature"] for r in out.weights.collect()] == [*out.features, None]
    new = spark.createDataFrame([(30.0, 1.0), (-5.0, 1.0)], "x double, PER_game double")
    assert [r["prediction"] for r in out.score(new).orderBy(F.desc("x")).collect()] == [1.0, 0.0]
    out.write(str(tmp_path / "out"))
    again = PipelineModel.load(str(tmp_path / "out" / "model"))
    assert again.transform(new).count() == 2
    tree = experiment(rows, "tree", target="PER", key="id")
    assert sum(r["weight"] for r in tree.weights.collect()) == pytest.approx(1.0)


def test_log_loss_fails_on_a_label_without_a_score(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (2, [0.5, 0.5])], "label int, probability array<double>")
    with pytest.raises(Exception, match="no score for label 2"):
        E.log_loss(df).collect()


def test_a_nan_score_is_left_out_of_curves(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, float("nan")), (0, None)], "label int, score double")
    assert E.auroc(df).first()[0] == 1.0 and E.roc_curve(df).count() == 3
