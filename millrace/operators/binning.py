"""Equal-width and quantile bins."""

from __future__ import annotations

from collections.abc import Sequence
from math import isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.operators.selection import quantiles

# Fixed value: number of bins.
BINS = 5


def bin_number(value: Column, edges: Sequence[float], nan_bin: bool = False) -> Column:
    """Number of inner edges at or below the value; null stays null."""
    x = value.cast("double")
    number = F.when(x.isNotNull(), F.lit(0.0))
    for edge in edges:
        number = number + F.when(x >= F.lit(float(edge)), 1.0).otherwise(0.0)
    if nan_bin:
        return F.when(F.isnan(x), F.lit(float(len(edges) + 1))).otherwise(number)
    return F.when(F.isnan(x), F.raise_error(F.lit("NaN cannot be binned")).cast("double")).otherwise(number)


def fit_equal_width(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Inner edges of every column with a range, in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(ref(c)).alias(f"l{i}"), F.max(ref(c)).alias(f"h{i}")]
    row = df.agg(*aggs).first()
    edges = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"l{i}"], row[f"h{i}"]
        if lo is None or lo == hi:
            continue
        if isnan(lo) or isnan(hi):
            raise ValueError(f"column {c!r} holds NaN")
        width = (hi - lo) / bins
        edges[c] = [lo + k * width for k in range(1, bins)]
    return edges


def equal_width_bins(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> DataFrame:
    """Add ``c_equal_width``, 0 to bins - 1; columns without a range are left alone."""
    if not cols:
        return df
    edges = fit_equal_width(df, cols, bins)
    return df.select("*", *[bin_number(ref(c), e).alias(f"{c}_equal_width") for c, e in edges.items()])


def fit_quantiles(
    df: DataFrame, cols: Sequence[str], bins: int = BINS, rel_error: float = 0.0
) -> dict[str, list[float]]:
    """Distinct inner quantiles of every column; exact, for all columns together, when ``rel_error`` is 0."""
    shares = [k / bins for k in range(1, bins)]
    if rel_error > 0:
        found = df.approxQuantile([c for c in cols], shares, rel_error)
        return {c: sorted(set(values)) for c, values in zip(cols, found)}
    edges: dict[str, set[float]] = {c: set() for c in cols}
    for r in quantiles(df, cols, shares, interpolate=False).collect():
        edges[r["column"]].add(float(r["value"]))
    return {c: sorted(found) for c, found in edges.items()}


def quantile_bins(
    df: DataFrame, cols: Sequence[str], bins: int = BINS, rel_error: float = 0.0
) -> DataFrame:
    """Add ``c_quantile``; equal edges collapse, NaN gets a bin after the last, null stays null."""
    if not cols:
        return df
    edges = fit_quantiles(df, cols, bins, rel_error)
    return df.select(
        "*", *[bin_number(ref(c), e, nan_bin=True).alias(f"{c}_quantile") for c, e in edges.items()]
    )
