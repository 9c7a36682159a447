"""Components of wide tables against the exact ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import stats as St
from millrace.operators import subspace as Su


def wide(spark, n=400, p=40, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 5)) * [9, 5, 3, 2, 1] @ r.normal(size=(5, p)) + 0.05 * r.normal(size=(n, p)) + 1e4
    cols = [f"c{i}" for i in range(p)]
    return spark.createDataFrame([tuple(map(float, row)) for row in x], ", ".join(f"{c} double" for c in cols)).repartition(3), cols, x


def test_first_components_of_a_wide_table(spark):
    df, cols, x = wide(spark)
    found = Su.pca_top(df, cols, 3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert found.readings <= 10
    for j in range(3):
        assert abs(found.pc[:, j] @ vectors[:, -1 - j]) == pytest.approx(1.0, abs=1e-8)
        assert found.ratios[j] == pytest.approx(values[-1 - j] / values.sum(), rel=1e-8)
    assert (found.pc[np.abs(found.pc).argmax(0), range(3)] > 0).all()
    scores = np.array([[r[f"PC{j + 1}"] for j in range(3)] for r in Su.project_top(df, found).select("PC1", "PC2", "PC3").collect()])
    assert np.sort(scores[:, 0]) == pytest.approx(np.sort(x @ found.pc[:, 0]), rel=1e-9)


def test_all_components_equal_the_built_in_fit(spark):
    df, cols, _ = wide(spark, p=6)
    found, model = Su.pca_top(df, cols, 6), St.pca_fit(df, cols)
    assert found.readings == 1
    # The built-in fit forms the matrix from uncentred sums, which costs it digits here.
    assert found.ratios == pytest.approx(list(model.explainedVariance.toArray()), abs=1e-6)


def test_nulls_flat_columns_and_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    found = Su.pca_top(df, ["a", "b", "c"], 2)
    assert found.pc[2] == pytest.approx([0.0, 0.0], abs=1e-12) and sum(found.ratios) == pytest.approx(1.0)
    gap = df.withColumn("a", F.when(F.col("a") > 1, F.col("a")))
    assert [r["PC1"] is None for r in Su.project_top(gap, found).orderBy("b").collect()] == [True, False, False]
    with pytest.raises(Exception, match="fill missing values"):
        Su.pca_top(gap, ["a", "b"], 1)
    with pytest.raises(ValueError, match="two rows"):
        Su.pca_top(df.limit(1), ["a", "b"], 1)
