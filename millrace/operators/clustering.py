"""K-means and assignment to given centres."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import fresh_name, ref
from millrace.operators.joint_kmeans import kmeans_joint, nearest_number
from millrace.session import materialize

# Cluster counts tried, cluster count used, passes, seed.
ELBOW_KS = (3, 4, 5, 6, 7)
CLUSTERS = 4
MAX_ITER = 20
SEED = 42
MAX_CLASSES = 10_000


def kmeans_fit(
    vectors: DataFrame, k: int, max_iter: int = MAX_ITER, seed: int = SEED, features: str = "features"
) -> KMeansModel:
    """Fit on an assembled vector column."""
    return KMeans(k=k, featuresCol=features, predictionCol="cluster", maxIter=max_iter, seed=seed).fit(
        vectors
    )


def kmeans_elbow(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = ELBOW_KS, seed: int = SEED
) -> DataFrame:
    """``(k, cost, centers)`` for every cluster count; all counts are fitted together."""
    fits = kmeans_joint(df, cols, ks, MAX_ITER, seed)
    rows = [(k, f.cost, f.centers.tolist()) for k, f in fits.items()]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, centers array<array<double>>")


def kmeans_assign(
    df: DataFrame,
    cols: Sequence[str],
    k: int = CLUSTERS,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    out: str = "cluster",
) -> DataFrame:
    """Add the cluster number of each row; rows with a missing or non-finite feature are dropped.

    The table is read for the fit and for the result; costly inputs should be stored.
    """
    return assign_to(df, cols, kmeans_centers(df, cols, k, max_iter, seed), out)


def kmeans_centers(
    df: DataFrame, cols: Sequence[str], k: int = CLUSTERS, max_iter: int = MAX_ITER, seed: int = SEED
) -> list[list[float]]:
    """The fitted centres; none for a table without complete rows."""
    fits = kmeans_joint(df, cols, (k,), max_iter, seed)
    return fits[k].centers.tolist() if fits else []


def assign_to(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Add the number of the nearest centre; rows with a missing or non-finite feature are dropped."""
    finite = F.lit(True)
    for c in cols:
        x = ref(c).cast("double")
        finite = finite & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = df.filter(finite)
    number = nearest_number(cols, np.array(centers)) if len(centers) else F.lit(None).cast("int")
    return rows.withColumn(out, number)


def class_centroids(
    df: DataFrame, label: str, col: str, max_classes: int = MAX_CLASSES
) -> list[tuple[int, list[float]]]:
    """``(label, mean vector)`` of every class, in class order; fails beyond ``max_classes``,
    as the centres go to the driver and to every task. ``nearest_class`` takes any number."""
    means = df.groupBy(ref(label).alias("label")).agg(
        Summarizer.mean(array_to_vector(ref(col).cast("array<double>"))).alias("center")
    )
    rows = means.filter("label is not null").orderBy("label").limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    return [(int(r["label"]), [float(x) for x in r["center"]]) for r in rows]


def _distance_matrix(points: pd.Series, centers: Sequence[Sequence[float]]) -> np.ndarray:
    """Squared distances of a batch of points to every centre, one centre at a time."""
    x = np.stack(points.to_numpy()).astype("float64")
    return np.stack([((x - np.array(c)) ** 2).sum(axis=1) for c in centers], axis=1)


def centroid_distances(col: str, centroids: Sequence[Sequence[float]]) -> Column:
    """Squared distances of an array column to the centres, as an array in their order."""
    centroids = [c[1] if isinstance(c, tuple) else c for c in centroids]

    @F.pandas_udf("array<double>")
    def distances(points: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(points), index=points.index, dtype="object")
        known = points.dropna()
        if len(known):
            out.loc[known.index] = pd.Series(list(_distance_matrix(known, centroids)), index=known.index)
        return out

    return distances(ref(col))


def nearest_centroid(
    df: DataFrame,
    centroids: Sequence[Sequence[float] | tuple[int, Sequence[float]]],
    col: str,
    out: str = "cluster",
) -> DataFrame:
    """Add the number of the nearest centre, the first one on ties.

    Centres given as ``(label, vector)`` are named by their labels, others by position.
    Works on Arrow batches: several times faster than array expressions, which
    walk the elements one by one.
    """

    pairs = [c if isinstance(c, tuple) else (i, c) for i, c in enumerate(centroids)]
    names, vectors = np.array([i for i, _ in pairs]), [v for _, v in pairs]

    @F.pandas_udf("int")
    def nearest(points: pd.Series) -> pd.Series:
        known = points.dropna()
        if not len(known):
            return pd.Series([None] * len(points), dtype="object")
        found = pd.Series(names[_distance_matrix(known, vectors).argmin(axis=1)], index=known.index)
        return found.reindex(points.index).astype("Int32")

    return df.withColumn(out, nearest(ref(col)))


def nearest_class(
    df: DataFrame, label: str, col: str, out: str = "cluster", block: int = MAX_CLASSES
) -> DataFrame:
    """Add the class whose mean vector is nearest, the smallest class on ties; any number of classes.

    The means stay in a stored table and come to the tasks ``block`` at a time; the rows and the
    best class so far are stored between blocks. Rows without a vector get null. Nothing is near
    in a table without labelled vectors.
    """
    means = materialize(
        df.filter(ref(col).isNotNull() & ref(label).isNotNull())
        .groupBy(ref(label).cast("bigint").alias("label"))
        .agg(Summarizer.mean(array_to_vector(ref(col).cast("array<double>"))).alias("center"))
        .select("label", vector_to_array("center").alias("center")),
        "class-means",
    )
    blocks = -(-means.count() // block)
    best = fresh_name(df, "__best")
    kind = "struct<d:double,label:bigint>"
    rows = df.withColumn(best, F.lit(None).cast(kind))
    # Classes are dealt by their hash; a block that gets more than its share is cut again.
    dealt = means.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(max(1, 2 * blocks))))
    for number in range(2 * blocks if blocks > 1 else blocks):
        mine = dealt.filter(F.col("block") == number) if blocks > 1 else dealt
        found = [(r["label"], r["center"]) for r in mine.orderBy("label").toLocalIterator()]
        for at in range(0, len(found), block):
            rows = rows.withColumn(best, _better(rows, col, found[at : at + block], best))
            if blocks > 1:
                rows = materialize(rows, "nearest-so-far")
    return rows.select(*[ref(c) for c in df.columns], F.col(best)["label"].cast("int").alias(out))


def _better(rows: DataFrame, col: str, centers: list, best: str) -> Column:
    """The best of what is known and the given centres: least distance, then smallest label."""
    names, vectors = np.array([n for n, _ in centers]), [v for _, v in centers]

    @F.pandas_udf("struct<d:double,label:bigint>")
    def nearest(points: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"d": np.nan, "label": 0}, index=points.index).astype({"label": "int64"})
        known = points.dropna()
        if len(known):
            far = _distance_matrix(known, vectors)
            own = far.argmin(axis=1)
            out.loc[known.index, "d"] = far[np.arange(len(known)), own]
            out.loc[known.index, "label"] = names[own]
        return out

    new = F.when(ref(col).isNotNull(), nearest(ref(col)))
    return F.coalesce(F.least(F.col(best), new), F.col(best), new)
