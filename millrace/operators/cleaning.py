"""Removing copies, filling gaps, cutting outliers, counting what is missing."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import numeric_columns, ref
from millrace.functions.scalars import UNKNOWN_TEXT, row_key, unit_hash
from millrace.session import materialize


def dedup_rows(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct value of all columns, or of ``subset``.

    Copies are merged before the shuffle. With a subset, the row that comes
    first by ``order_by`` (default: the remaining columns) is kept, so the
    result does not depend on the partitioning.
    """
    if subset is None:
        return df.dropDuplicates()
    keys = list(subset)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    row = F.struct(*[ref(c) for c in rest])
    order = F.struct(*[ref(c) for c in (order_by or rest)])
    kept = df.groupBy(*[ref(c) for c in keys]).agg(F.min_by(row, order).alias("__row"))
    return kept.select(
        *[ref(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def fill_strings(
    df: DataFrame, value: str = UNKNOWN_TEXT, skip: Iterable[str] = ("height",)
) -> DataFrame:
    """Null text replaced by ``value`` in all string columns but the skipped ones."""
    skipped = set(skip)
    return df.select(
        *[
            F.coalesce(ref(c), F.lit(value)).alias(c) if kind == "string" and c not in skipped else ref(c)
            for c, kind in df.dtypes
        ]
    )


def fit_means(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float | None]:
    """Mean of every column over its non-null rows, in one pass."""
    cols = numeric_columns(df) if cols is None else list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.avg(ref(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def fill_values(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Nulls replaced by one number per column; integer columns become double."""
    return df.select(
        *[
            F.coalesce(ref(c), F.lit(values[c]).cast("double")).alias(c) if c in values else ref(c)
            for c in df.columns
        ]
    )


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls of numeric columns replaced by the column mean. NaN is not null."""
    return fill_values(df, fit_means(df, cols))


#: Share of the limit beyond which a row is looked at by itself, and the most sets of missing
#: columns and rows of that kind that are kept.
WATCHED, MASKS = 0.8, 10_000


def _rest(df: DataFrame, cols: Sequence[str], about: Sequence[float], bounds: Sequence[float]) -> DataFrame:
    """The rows summed up by the set of columns they miss (``mask``), but rows beyond a bound one by
    one: ``n``, and for each column ``s`` and ``q``, sums of what it is off ``about`` and of its
    square, and ``x``, its value in a row that stands for itself."""
    values = [F.col(f"c{i}") for i in range(len(cols))]
    rows = df.select(*[ref(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    far = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.abs(v - F.lit(m)) > F.lit(t), F.lit(False)) for v, m, t in zip(values, about, bounds)],
    )
    mask = reduce(lambda a, b: a + b, [F.when(v.isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(values)])
    own = F.when(far, F.monotonically_increasing_id())
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (v, m) in enumerate(zip(values, about)):
        off = v - F.lit(m)
        aggs += [F.sum(off).alias(f"s{i}"), F.sum(off * off).alias(f"q{i}"), F.max(v).alias(f"x{i}")]
    told = rows.select(*values, mask.cast("bigint").alias("mask"), own.alias("own"))
    return told.groupBy("mask", "own").agg(*aggs)


def _column_by_column(df: DataFrame, cols: Sequence[str], limit: float) -> list[tuple[str, float, float]]:
    """``(column, mean, deviation)`` of the columns that are judged, one statistics pass for each."""
    narrow, out = df.select(*[ref(c) for c in cols]), []
    for name in cols:
        c = ref(name)
        mean, spread = narrow.agg(F.avg(c), F.stddev(c)).first()
        if not spread:
            continue
        out.append((name, mean, spread))
        narrow = narrow.filter(F.abs((c - F.lit(mean)) / F.lit(spread)) <= F.lit(float(limit)))
    return out


def outlier_limits(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> list[tuple[str, float, float]]:
    """``(column, mean, deviation)`` of every column with a spread, each on the rows that the
    former ones left, from two readings of the table.

    The first reading takes rough means and deviations of all columns. The second sums up the
    rows by the columns they miss; rows that may be removed, those beyond ``WATCHED`` of a limit,
    stay single. The columns are then judged one after the other on this small table. Sums of
    what is left are added up anew each time, around the rough means, so neither large means nor
    removed outliers cost digits. Should the limits close in on rows that were summed up, the
    second reading is repeated with narrower bounds.
    """
    cols = list(cols)
    # A set of missing columns is one number; a column named twice is judged twice.
    if not cols or len(cols) > 60 or len(set(cols)) < len(cols):
        return _column_by_column(df, cols, limit)
    rough = df.agg(*[f(ref(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("d", F.stddev))]).first()
    about = [rough[f"m{i}"] or 0.0 for i in range(len(cols))]
    spread = [rough[f"d{i}"] or 0.0 for i in range(len(cols))]
    if not all(math.isfinite(x) for x in (*about, *spread)):
        return _column_by_column(df, cols, limit)
    # A column without any spread has none in a part of its rows.
    about, spread, cols = (list(x) for x in zip(*[x for x in zip(about, spread, cols) if x[1]])) if any(spread) else ([], [], [])
    if not cols:
        return []
    for share in (WATCHED, WATCHED / 2, WATCHED / 8):
        bounds = [max(share * limit * d, 1e-12 * abs(m)) for d, m in zip(spread, about)]
        rest = materialize(_rest(df, cols, about, bounds), "watched-rows")
        if rest.filter("own is null").count() > MASKS:
            break
        found = _judged(rest, cols, limit, about, bounds)
        if found is not None:
            return found
    return _column_by_column(df, cols, limit)


def _judged(rest: DataFrame, cols, limit, about, bounds) -> list[tuple[str, float, float]] | None:
    """The limits by the small table; None when one lies within the bound of a column."""
    out = []
    for i, name in enumerate(cols):
        n, s, q = rest.filter(F.col(f"s{i}").isNotNull()).agg(F.sum("n"), F.sum(f"s{i}"), F.sum(f"q{i}")).first()
        if not n or n < 2:
            continue
        mean, variance = about[i] + s / n, (q - s * s / n) / (n - 1)
        deviation = math.sqrt(max(0.0, variance))
        # Rows that do not differ at all leave at most rounding noise.
        least, most = rest.agg(F.min(f"x{i}"), F.max(f"x{i}")).first()
        if deviation == 0.0 or least == most and deviation <= 1e-12 * abs(mean):
            continue
        low, high = mean - limit * deviation, mean + limit * deviation
        if high < about[i] + bounds[i] or low > about[i] - bounds[i]:
            return None
        out.append((name, mean, deviation))
        x = F.col(f"x{i}")
        within = F.abs((x - F.lit(mean)) / F.lit(deviation)) <= F.lit(float(limit))
        # Summed rows are all within; they go only if they miss the column.
        rest = rest.filter(F.when(F.col("own").isNull(), F.col("mask").bitwiseAND(F.lit(1 << i)) == 0).otherwise(within))
    return out


def zscore_filter(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Keep rows within ``limit`` sample deviations of the mean, column after column.

    Each column is judged on the rows the former ones left, see ``outlier_limits``: two readings
    of the table for any number of columns. Columns without spread are skipped; nulls in judged
    columns are dropped.
    """
    for name, mean, deviation in outlier_limits(df, cols, limit):
        df = df.filter(F.abs((ref(name) - F.lit(mean)) / F.lit(deviation)) <= F.lit(float(limit)))
    return df


def missing_profile(df: DataFrame) -> DataFrame:
    """``(position, column, missing)``: null count of every column, in one pass."""
    counts = df.agg(
        *[F.count_if(ref(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def missing_topk(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` columns with most nulls; ties in column order."""
    ranked = missing_profile(df).orderBy(F.desc("missing"), F.asc("position")).limit(k)
    return ranked.select("column", "missing")


def sample_rows(
    df: DataFrame, fraction: float, key: str | None = None, seed: int = 42
) -> DataFrame:
    """A random share of the rows.

    With ``key`` the choice depends on key and seed only, and survives any
    repartitioning; rows without a key are chosen by their content. Without
    ``key`` Spark's sampler is used.
    """
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(unit_hash(row_key(key, df.columns), seed) < F.lit(fraction))
