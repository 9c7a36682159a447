"""K-means for several cluster counts at once: the same as one by one, and block by block."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clustering as Cl
from millrace.operators import joint_kmeans as J


def points(seed, n=3_000, spread=0.6, at=0.0):
    r = random.Random(seed)
    spots = [(0, 0), (9, 1), (4, 8), (-6, 5)]
    return [tuple(at + c + r.gauss(0, spread) for c in r.choice(spots)) for _ in range(n)]


def lloyd(x, centers, max_iter, tolerance=J.TOLERANCE):
    for step in range(max_iter + 1):
        away = ((x[:, None] - centers) ** 2).sum(2)
        own = away.argmin(1)
        new = np.array([x[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centers)])
        if (((new - centers) ** 2).sum(1) <= tolerance**2).all() or step == max_iter:
            return centers, np.bincount(own, minlength=len(centers)), away.min(1).sum(), step
        centers = new


@pytest.mark.parametrize("spread,at", [(0.6, 0.0), (4.0, 0.0), (0.6, 1e8)])
def test_joint_fits_equal_separate_ones_and_plain_lloyd(spark, spread, at):
    rows = points(1, spread=spread, at=at)
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    joint = J.kmeans_joint(df, ["a", "b"], (3, 4, 7), max_iter=12)
    sample = J._sample(df, ["a", "b"])
    for k, fit in joint.items():
        alone = J.kmeans_joint(df, ["a", "b"], (k,), max_iter=12)[k]
        centers, sizes, cost, steps = lloyd(np.array(rows), J.first_centers(sample, k, 42), 12)
        for other in (alone.centers, centers):
            assert np.abs(fit.centers - other).max() <= 1e-9 * max(1.0, at)
        assert fit.iterations == alone.iterations == steps and (fit.sizes == sizes).all()
        assert fit.cost == pytest.approx(cost, rel=1e-6) and fit.sizes.sum() == len(rows)


def test_blocks_owned_by_one_centre_are_not_looked_at(spark):
    df = spark.createDataFrame(points(2, 20_000, 0.3), "a double, b double").repartition(3)
    centers = {4: np.array([(0.0, 0.0), (9.0, 1.0), (4.0, 8.0), (-6.0, 5.0)])}
    sums = J._pass(J.blocks(df, ["a", "b"]), centers)
    assert sums.n[4].sum() == 20_000 and sums.looked < 10_000


def test_owner_is_nearest_to_every_point_of_the_box():
    r = np.random.default_rng(3)
    for _ in range(200):
        low = r.normal(0, 3, (5, 3))
        high = low + r.exponential(1, (5, 3)) * r.integers(0, 2)
        centers = r.normal(0, 3, (4, 3))
        for i, owner in enumerate(J.owners(low, high, centers)):
            x = low[i] + r.random((60, 3)) * (high[i] - low[i])
            own = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
            assert owner < 0 or (own == owner).all()


def test_as_good_as_the_built_in_fit(spark):
    df = spark.createDataFrame(points(4, 4_000, 2.5), "a double, b double")
    from millrace.operators.scaling import assemble

    built_in = Cl.kmeans_fit(assemble(df, ["a", "b"]), 4).summary.trainingCost
    assert J.kmeans_joint(df, ["a", "b"], (4,), max_iter=60)[4].cost <= 1.02 * built_in


def test_few_rows_gaps_and_none(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (1.0, 1.0), (5.0, 5.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 0.0)], "a double, b double"
    )
    fit = J.kmeans_joint(df, ["a", "b"], (4,))[4]
    assert fit.cost == 0.0 and fit.sizes.sum() == 3
    assert Cl.kmeans_assign(df, ["a", "b"], 4).count() == 3
    empty = df.filter("a > 100 and a < 101")
    assert J.kmeans_joint(empty, ["a", "b"], (3,)) == {} and Cl.kmeans_elbow(empty, ["a", "b"]).count() == 0
    assert Cl.kmeans_assign(empty, ["a", "b"], 3).columns == ["a", "b", "cluster"]


def test_assignment_is_to_the_first_nearest_centre(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("x"))
    got = Cl.assign_to(df, ["x"], [[0.0], [2.0], [2.0], [4.0]]).orderBy("x").collect()
    assert [r["cluster"] for r in got] == [0, 0, 1, 1, 3]
