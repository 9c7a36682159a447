"""Feature vectors and scaled columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import numeric_columns, ref
from millrace.operators.distribution import histogram


def assemble(
    df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error"
) -> DataFrame:
    """Columns as one vector. ``keep`` turns null to NaN, ``skip`` drops the row, ``error`` fails."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def explode_vector(df: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """One column per vector element, in a single projection."""
    kept = [ref(c) for c in df.columns if c != col]
    array = df.withColumn("__array", vector_to_array(ref(col)))
    return array.select(
        *kept, *[F.get(F.col("__array"), F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """``(min, max, mean, stddev)`` of every column, in one pass."""
    aggs = []
    for i, name in enumerate(cols):
        c = ref(name).cast("double")
        aggs += [
            F.min(c).alias(f"l{i}"),
            F.max(c).alias(f"h{i}"),
            F.avg(c).alias(f"a{i}"),
            F.stddev(c).alias(f"s{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: (row[f"l{i}"], row[f"h{i}"], row[f"a{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def _minmax(name: str, fitted: tuple):
    lo, hi = fitted[0], fitted[1]
    c = ref(name).cast("double")
    if lo is None:
        return F.lit(None).cast("double")
    if lo == hi:
        return F.when(c.isNotNull(), F.lit(0.5))
    return (c - F.lit(lo)) / F.lit(hi - lo)


def _standard(name: str, fitted: tuple):
    mean, spread = fitted[2], fitted[3]
    c = ref(name).cast("double")
    if mean is None:
        return F.lit(None).cast("double")
    if not spread:
        return F.when(c.isNotNull(), F.lit(0.0))
    return (c - F.lit(mean)) / F.lit(spread)


def minmax_scale(
    df: DataFrame, cols: Sequence[str] | None = None, fitted: dict | None = None
) -> DataFrame:
    """Add ``c_minmax`` in 0..1; a constant column becomes 0.5."""
    cols = numeric_columns(df) if cols is None else list(cols)
    fitted = fitted or fit_scale(df, cols)
    return df.select("*", *[_minmax(c, fitted[c]).alias(f"{c}_minmax") for c in cols])


def standard_scale(
    df: DataFrame, cols: Sequence[str] | None = None, fitted: dict | None = None
) -> DataFrame:
    """Add ``c_standard`` with mean 0 and sample deviation 1; a constant column becomes 0."""
    cols = numeric_columns(df) if cols is None else list(cols)
    fitted = fitted or fit_scale(df, cols)
    return df.select("*", *[_standard(c, fitted[c]).alias(f"{c}_standard") for c in cols])


def scale_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Both scalings from one statistics pass, after dropping rows with a missing value."""
    cols = numeric_columns(df) if cols is None else list(cols)
    if not cols:
        return df
    complete = df.na.drop(subset=cols)
    fitted = fit_scale(complete, cols)
    return standard_scale(minmax_scale(complete, cols, fitted), cols, fitted)


def scaling_histograms(scaled: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Histograms of a column and of its two scaled copies, told apart by ``version``."""
    parts = [
        histogram(scaled, name, bins).withColumn("version", F.lit(version))
        for version, name in (
            ("original", col),
            ("minmax", f"{col}_minmax"),
            ("standard", f"{col}_standard"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
