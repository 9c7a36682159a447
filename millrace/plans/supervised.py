"""One model experiment: target, label, split, fit, and every evaluation table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import find_target, ref, select_features
from millrace.operators.evaluation import (
    averaged_metrics,
    classification_report,
    confusion_matrix,
    pr_from,
    report_text,
    results_table,
    roc_from,
)
from millrace.operators.labeling import TRAIN_TEST, label_above_mean, label_from_bin, split_rows
from millrace.operators.models import SPLIT_SEEDS, evaluate, export_predictions, feature_weights, predict
from millrace.session import materialize
from millrace.sources.tables import write_table, write_text

# Where the target is looked for, in this order.
TARGETS = ("ss_PER_quantile", "ss_PER", "PER")
TARGET_TEXT = "PER"
# Endings of the columns that the stages make from another one.
DERIVED = ("minmax", "standard", "index", "onehot", "equal_width", "quantile")


@dataclass(frozen=True)
class Experiment:
    """A fitted model, its features and weights, and the tables that measure it."""

    model: PipelineModel
    features: tuple[str, ...]
    weights: DataFrame
    results: DataFrame
    confusion: DataFrame
    averages: DataFrame
    report: DataFrame
    roc: DataFrame | None
    pr: DataFrame | None
    predictions: DataFrame

    def score(self, df: DataFrame) -> DataFrame:
        """Any table with the features, scored by the model; incomplete rows as in training."""
        return predict(self.model, df)

    def write(self, path: str, fmt: str = "csv") -> None:
        """Write every table to a folder of its own, and the report as text too."""
        root = path.rstrip("/")
        for name, df in vars(self).items():
            if isinstance(df, DataFrame):
                write_table(df, f"{root}/{name}", fmt)
        self.model.write().overwrite().save(f"{root}/model")
        write_text(self.report.sparkSession, report_text(self.report), f"{root}/report_text")


def derived_from(column: str, base: str) -> bool:
    """Whether a prepared column is ``base`` or was made from it by scaling, encoding or binning."""
    return re.fullmatch(re.escape(base) + f"(_({'|'.join(DERIVED)}))*", column) is not None


def experiment(
    df: DataFrame,
    kind: str,
    target: str | None = None,
    targets: Sequence[str] = TARGETS,
    key: str | None = None,
    features: Sequence[str] | None = None,
    drop_derived: bool = True,
    null_target: str = "drop",
    fit_on: str = "train",
    classes: Sequence[str] | None = None,
    **settings,
) -> Experiment:
    """Train and measure one classifier on a prepared table.

    A bin column (``*_quantile``) as target gives one class per bin, any other
    number is cut at its mean. ``drop_derived`` leaves out columns made from the
    target, ``fit_on`` says whether the scaler learns from the training rows or
    from all rows. With ``key`` the split does not depend on the storage.
    """
    if fit_on not in ("train", "all"):
        raise ValueError(f"unknown choice {fit_on!r}")
    target = target or find_target(df, targets, TARGET_TEXT)
    binned = target.endswith("_quantile")
    labelled = label_from_bin(df, target) if binned else label_above_mean(df, target, null_target)
    if features is None:
        base = target.removesuffix("_quantile") if binned else target
        names = select_features(df, target, drop_derived=False)
        features = [
            c
            for c in names
            if c not in (key, "label") and not (drop_derived and derived_from(c, base))
        ]
    kept = [*features, *([key] if key else [])]
    rows = materialize(labelled.select(*[ref(c) for c in kept], "label"), "model-rows")
    n_classes = int(rows.agg(F.max("label")).first()[0]) + 1 if binned else 2
    train_rows, test_rows = split_rows(rows, TRAIN_TEST, key=key, seed=SPLIT_SEEDS[kind])
    row, tested, points, model = evaluate(
        kind,
        train_rows,
        test_rows,
        features,
        classes=n_classes,
        scale_rows=rows if fit_on == "all" else None,
        **settings,
    )
    return Experiment(
        model=model,
        features=tuple(features),
        weights=feature_weights(model, features, df.sparkSession),
        results=results_table(df.sparkSession, [row]),
        confusion=confusion_matrix(tested),
        averages=averaged_metrics(tested),
        report=classification_report(tested, classes),
        roc=None if points is None else roc_from(points),
        pr=None if points is None else pr_from(points),
        predictions=export_predictions(tested),
    )
