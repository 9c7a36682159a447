"""Scaling, encoding, binning, clustering and statistics on edge cases."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import Bucketizer, MinMaxScaler, QuantileDiscretizer, StandardScaler, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from millrace.operators import binning as B
from millrace.operators import clustering as Cl
from millrace.operators import encoding as En
from millrace.operators import scaling as Sc
from millrace.operators import stats as St


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(5, 2), rng.random(), 7.0) for i in range(200)]
    return spark.createDataFrame(rows, "id int, a double, b double, flat double").repartition(3).cache()


def test_scaling_equals_the_built_in_scalers(numbers):
    cols = ["a", "b", "flat"]
    out = Sc.scale_all(numbers, cols)
    vec = Sc.assemble(numbers, cols, "v")
    for model, suffix in (
        (MinMaxScaler(inputCol="v", outputCol="s"), "minmax"),
        (StandardScaler(inputCol="v", outputCol="s", withMean=True), "standard"),
    ):
        want = {r["id"]: r["x"] for r in model.fit(vec).transform(vec).select("id", vector_to_array("s").alias("x")).collect()}
        for r in out.collect():
            assert [r[f"{c}_{suffix}"] for c in cols] == pytest.approx(want[r["id"]], abs=1e-9)


def test_scale_all_drops_incomplete_rows_first(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, None), (5.0, 3.0)], "a double, b double")
    assert sorted(r["a_minmax"] for r in Sc.scale_all(df).collect()) == [0.0, 1.0]


def test_assemble_policies(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 4.0)], "a double, b double")
    assert Sc.assemble(df, ["a", "b"], invalid="keep").count() == 3
    assert Sc.assemble(df, ["a", "b"], invalid="skip").count() == 1
    with pytest.raises(Exception):
        Sc.assemble(df, ["a", "b"]).collect()


WORDS = ["b", "b", "a", "a", "c", "c", "c", None, "d"]


@pytest.mark.parametrize("short_list", [2, 100])
def test_string_index_equals_the_built_in(spark, short_list):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)], "id int, w string").repartition(3)
    got = {r["id"]: r["w_index"] for r in En.string_index(df, ["w"], short_list=short_list).collect()}
    built_in = StringIndexer(inputCol="w", outputCol="x", handleInvalid="keep").fit(df).transform(df)
    assert got == {r["id"]: r["x"] for r in built_in.collect()}


def test_string_index_policies(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "w string")
    assert En.string_index(df, ["w"], "skip").count() == 8
    with pytest.raises(Exception):
        En.string_index(df, ["w"], "error").collect()


def test_long_labels_are_not_broadcast(spark):
    df = spark.createDataFrame([("x" * 5000,), ("y" * 5000,), ("y" * 5000,)], "w string")
    _, size, short = En.label_ranks(df, "w")
    assert (size, short) == (2, False)
    assert sorted(r["w_index"] for r in En.string_index(df, ["w"]).collect()) == [0.0, 0.0, 1.0]


def test_many_labels_rank_in_order(spark):
    df = spark.range(5000).select(F.format_string("%05d", F.col("id")).alias("w")).repartition(7)
    out = En.string_index(df, ["w"], short_list=10).select("w", "w_index").collect()
    assert all(r["w_index"] == float(int(r["w"])) for r in out) and len(out) == 5000


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "w string")
    got = {r["w"]: r["w_index_onehot"] for r in En.encode(df, ["w"], sparse=False).collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 1.0], None: [0.0, 0.0]}
    indexed = En.string_index(df, ["w"])
    sparse = {r["w"]: r["w_index_onehot"] for r in En.one_hot(indexed, ["w"], {"w": 2}).collect()}
    assert sparse["b"]["indices"] == [1] and sparse[None]["indices"] == [] and sparse["a"]["size"] == 2


def test_one_hot_type_does_not_follow_the_labels(spark):
    kinds = {
        En.encode(spark.range(n).select(F.col("id").cast("string").alias("w")), ["w"]).dtypes[-1][1] for n in (2, 1500)
    }
    assert len(kinds) == 1


@pytest.mark.parametrize("terms", [0, 1000])
def test_a_null_makes_all_components_null(spark, monkeypatch, terms):
    monkeypatch.setattr(St, "PROJECTION_TERMS", terms)
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "a double, b double")
    model = St.pca_fit(df, ["a", "b"])
    out = St.pca_project(spark.createDataFrame([(None, 1.0)], "a double, b double"), ["a", "b"], model, 2).first()
    assert out["PC1"] is None and out["PC2"] is None


def test_a_column_constant_beside_another_is_kept(spark):
    rng = random.Random(4)
    for seed in range(6):
        rows = [
            (rng.gauss(0, 1) if i % 3 else None, 0.1 if i % 3 else 0.5 + seed, rng.choice([None, 0.1 * seed])) for i in range(300)
        ]
        df = spark.createDataFrame(rows, "a double, k double, c double")
        corr = St.correlation_matrix(df).collect()
        assert all(r["corr"] is None or r["corr"] == r["corr"] for r in corr)
        frame = pd.DataFrame(rows, columns=["a", "k", "c"]).astype(float)
        for r in corr:
            want = frame[r["col_i"]].corr(frame[r["col_j"]])
            if abs(want) > 1e-3:
                assert r["corr"] == pytest.approx(abs(want), abs=1e-6)
        assert St.redundant_columns(df) == []


def test_centres_are_named_by_their_class(spark):
    df = spark.createDataFrame([(3, [0.0]), (7, [9.0]), (None, [5.0])], "label int, v array<double>")
    centers = Cl.class_centroids(df, "label", "v")
    assert [label for label, _ in centers] == [3, 7]
    assert [r["cluster"] for r in Cl.nearest_centroid(df.filter("label is not null"), centers, "v").collect()] == [3, 7]
    with pytest.raises(ValueError):
        Cl.class_centroids(df, "label", "v", max_classes=1)


def test_equal_width_equals_bucketizer(spark, numbers):
    lo, hi = numbers.agg(F.min("a"), F.max("a")).first()
    edges = [-math.inf, *[lo + i * (hi - lo) / 5 for i in range(1, 5)], math.inf]
    want = Bucketizer(splits=edges, inputCol="a", outputCol="x").transform(numbers)
    got = B.equal_width_bins(numbers, ["a", "flat"])
    assert "flat_equal_width" not in got.columns
    assert {r["id"]: r["x"] for r in want.collect()} == {r["id"]: r["a_equal_width"] for r in got.collect()}


def test_equal_width_rejects_nan_and_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (6.0,)], "x double")
    assert [r[1] for r in B.equal_width_bins(df, ["x"]).collect()] == [0.0, None, 4.0]
    with pytest.raises(ValueError):
        B.equal_width_bins(spark.createDataFrame([(1.0,), (float("nan"),)], "x double"), ["x"])


def test_quantile_bins_equal_the_built_in_at_error_zero(spark):
    rng = random.Random(4)
    rows = [(i, float(rng.randint(0, 30))) for i in range(300)] + [(300, None), (301, float("nan"))]
    df = spark.createDataFrame(rows, "id int, x double").repartition(4)
    model = QuantileDiscretizer(numBuckets=5, inputCol="x", outputCol="q", relativeError=0.0, handleInvalid="keep")
    want = {r["id"]: r["q"] for r in model.fit(df).transform(df).collect()}
    assert {r["id"]: r["x_quantile"] for r in B.quantile_bins(df, ["x"]).collect()} == want


def test_quantile_edges_collapse(spark):
    df = spark.createDataFrame([(1.0,)] * 90 + [(2.0,)] * 10, "x double")
    assert {r["x_quantile"] for r in B.quantile_bins(df, ["x"]).collect()} <= {1.0, 2.0}


def test_nearest_centroid_first_on_ties(spark):
    df = spark.createDataFrame([([0.0, 0.0],), (None,), ([3.0, 0.0],)], "v array<double>").coalesce(1)
    centers = [[1.0, 0.0], [-1.0, 0.0], [3.0, 0.5]]
    out = Cl.nearest_centroid(df, centers, "v").collect()
    assert [r["cluster"] for r in out] == [0, None, 2]
    distances = df.select(Cl.centroid_distances("v", centers).alias("d")).collect()
    assert [r["d"] for r in distances] == [[1.0, 1.0, 9.25], None, [4.0, 16.0, 0.25]]
    nulls = spark.createDataFrame([(None,)], "v array<double>")
    assert Cl.nearest_centroid(nulls, centers, "v").first()["cluster"] is None


def test_kmeans_finds_separate_groups(spark):
    rng = random.Random(8)
    rows = [(g, 100.0 * g + rng.random(), rng.random()) for g in range(4) for _ in range(50)] + [(9, None, 0.0)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    out = Cl.kmeans_assign(df, ["a", "b"], 4).groupBy("g").agg(F.count_distinct("cluster").alias("k")).collect()
    assert {(r["g"], r["k"]) for r in out} == {(g, 1) for g in range(4)}
    costs = [r["cost"] for r in Cl.kmeans_elbow(df, ["a", "b"], (3, 4)).orderBy("k").collect()]
    assert costs[1] < costs[0]


def test_correlation_is_pairwise_complete_and_null_safe(spark):
    rows = [(1.0, 2.0, None, 5.0), (2.0, 4.1, 1.0, 5.0), (3.0, 5.9, 0.0, 5.0), (4.0, None, float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double")
    got = {(r["col_i"], r["col_j"]): r["corr"] for r in St.correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(abs(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]))
    assert got["b", "c"] == pytest.approx(1.0) and got["a", "flat"] is None


def test_correlation_equals_the_built_in(spark, numbers):
    df = numbers.select("a", "b", (F.col("a") + F.col("b") + 1e9).alias("c"))
    want = Correlation.corr(Sc.assemble(df, ["a", "b", "c"], "v"), "v").first()[0].toArray()
    names = ["a", "b", "c"]
    for r in St.correlation_matrix(df).collect():
        assert r["corr"] == pytest.approx(abs(want[names.index(r["col_i"]), names.index(r["col_j"])]), abs=1e-4)


def test_pruning_is_not_greedy(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(500):
        x = rng.gauss(0, 1)
        y = x + rng.gauss(0, 0.45)
        rows.append((x, y, y + rng.gauss(0, 0.45)))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    # a-b and b-c are close, a-c is not: b goes because of a, c because of b
    assert St.redundant_columns(df) == ["b", "c"]
    assert St.prune_correlated(df).columns == ["a"]


def test_pca_ratios_and_projection(spark, numbers, monkeypatch):
    model = St.pca_fit(numbers, ["a", "b"])
    rows = St.pca_variance(numbers, model).orderBy("component").collect()
    assert [r["ratio"] for r in rows] == sorted((r["ratio"] for r in rows), reverse=True)
    assert rows[-1]["cumulative"] == pytest.approx(1.0)
    assert [r["kept"] for r in rows] == [True, False]
    basis = model.pc.toArray()
    for terms in (0, 1000):
        monkeypatch.setattr(St, "PROJECTION_TERMS", terms)
        out = St.pca_project(numbers, ["a", "b"], model, 2).first()
        assert [out["PC1"], out["PC2"]] == pytest.approx(list(np.array([out["a"], out["b"]]) @ basis))
    assert St.pca_keep([0.5, 0.3, 0.2], 0.95) == 3 and St.pca_keep([0.96, 0.04]) == 1


def test_group_sizes(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string")
    rows = [tuple(r) for r in St.group_sizes(df, "g").collect()]
    assert rows == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]
