"""Histograms, density curves, exact quantiles and box summaries.

Running totals sort no group as a whole: values are cut into ranges of similar
size, and each range is sorted on its own. Quantiles are selected, not sorted for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.operators.selection import quantiles
from millrace.session import broadcast_small

# Number of value ranges. Their cut points come from a sketch with an error of a quarter range.
RANGES = 1024


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``(bin, lo, hi, n)`` for equal-width bins, empty ones included, last one closed."""
    c = ref(col).cast("double")
    values = df.select(c.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    lo, hi = values.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    counts = values.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def label_threshold(df: DataFrame, target: str, bins: int = 35) -> DataFrame:
    """Histogram of the target with its mean as ``threshold`` and the bin that holds it."""
    mean = df.agg(F.avg(ref(target))).first()[0]
    inside = (F.col("lo") <= F.lit(mean)) & (F.lit(mean) < F.col("hi"))
    return histogram(df, target, bins).select(
        "*", F.lit(mean).alias("threshold"), inside.alias("holds_threshold")
    )


#: Width of a box of values in bandwidths, terms of the series around its middle, and how many
#: bandwidths away a box still counts. The series is cut where its next term, at most
#: ``(BOX / 2) ** TERMS / sqrt(TERMS!)`` of a value's own peak, is below 1e-18; a box further away
#: than ``REACH`` adds less than 1e-17 of it.
BOX, TERMS, REACH = 0.5, 18, 9.0


def kde(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """``(point, x, density)``: Gaussian kernel density on an even grid from min to max.

    The bandwidth is ``n^(-1/5)`` times the sample deviation. Values are summed up in boxes, as
    powers of their distance from the box's middle; a box then adds to the grid points near it by
    a Hermite series. Rows are neither multiplied nor shuffled, only the boxes are.
    """
    values = df.select(ref(col).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    n, lo, hi, spread = values.agg(
        F.count("v"), F.min("v"), F.max("v"), F.stddev("v")
    ).first()
    if not n or not spread:
        raise ValueError(f"column {col!r} has no spread")
    width = spread * n ** (-0.2)
    step = (hi - lo) / (points - 1)
    box = F.floor((F.col("v") - F.lit(lo)) / F.lit(width * BOX))
    middle = F.lit(lo) + (F.col("box") + 0.5) * F.lit(width * BOX)
    away = (F.col("v") - middle) / F.lit(width)
    moments = [
        (F.sum(F.pow("d", F.lit(float(k)))) / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k in range(TERMS)
    ]
    boxes = values.select("v", box.alias("box")).select("box", away.alias("d")).groupBy("box").agg(*moments)
    near = F.lit(width * (REACH + BOX))
    first = F.greatest(F.ceil((F.col("c") - near - F.lit(lo)) / F.lit(step)), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("c") + near - F.lit(lo)) / F.lit(step)), F.lit(points - 1)).cast("int")
    told = boxes.select(middle.alias("c"), F.array(*[f"m{k}" for k in range(TERMS)]).alias("m"))
    reached = told.withColumns({"first": first, "last": last}).filter("first <= last")
    laid = reached.select("c", "m", F.explode(F.sequence("first", "last")).alias("point"))
    t = (F.lit(lo) + F.col("point") * F.lit(step) - F.col("c")) / F.lit(width)
    laid = laid.select("point", "m", t.alias("t"))
    number = lambda x, name: F.lit(x).alias(name)
    # The Hermite polynomials one after the other: a is that of order k - 1, b that of order k.
    series = F.aggregate(
        "m", F.struct(number(0.0, "a"), number(1.0, "b"), number(0.0, "s"), number(0.0, "k")),
        lambda z, m: F.struct(
            z["b"].alias("a"), (F.col("t") * z["b"] - z["k"] * z["a"]).alias("b"), (z["s"] + z["b"] * m).alias("s"),
            (z["k"] + 1.0).alias("k"),
        ),
    )["s"]
    height = F.exp(F.col("t") * F.col("t") * F.lit(-0.5)) * series
    sums = laid.groupBy("point").agg(F.sum(height).alias("s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    norm = n * width * (2.0 * math.pi) ** 0.5
    return grid.join(sums, "point", "left").select(
        "point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"),
        (F.coalesce("s", F.lit(0.0)) / F.lit(norm)).alias("density"),
    )


def value_ranges(df: DataFrame, col: str, ranges: int = RANGES) -> list[float]:
    """Approximate cut points that split the values of ``col`` into even parts."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    numbers = df.select(ref(col).cast("double").alias("x"))
    return sorted(set(numbers.approxQuantile("x", shares, 0.25 / ranges)))


def with_range(df: DataFrame, col: str, cuts: Sequence[float], out: str = "__range") -> DataFrame:
    """Number of the value range each row falls in; larger values never get a smaller number."""
    edges = [float("-inf"), *[c for c in cuts if abs(c) != float("inf")], float("inf")]
    if len(edges) < 3:
        return df.withColumn(out, F.lit(0.0))
    numbered = df.withColumn("__as_double", ref(col).cast("double"))
    return (
        Bucketizer(splits=edges, inputCol="__as_double", outputCol=out)
        .transform(numbered)
        .drop("__as_double")
    )


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], descending: bool = False, ranges: int = RANGES
) -> tuple[DataFrame, dict[str, int]]:
    """``(order, v..., cum_v...)``, one row per distinct value of ``order``: the sum of each
    value column there and its total up to there. Also returns the overall totals.

    Rows are summed within value ranges, each sorted on its own; the totals of
    the ranges before, one row per range, are added to them.
    """
    cuts = value_ranges(df, order, ranges)
    per_range = with_range(df, order, cuts).groupBy("__range").agg(*[F.sum(v).alias(v) for v in values])
    upto = dict.fromkeys(values, 0)
    offsets = []
    for row in sorted(per_range.collect(), key=lambda r: r["__range"], reverse=descending):
        offsets.append((row["__range"], *[upto[v] for v in values]))
        upto = {v: upto[v] + row[v] for v in values}
    kinds = {f.name: f.dataType.simpleString() for f in per_range.schema.fields}
    schema = "__at double" + "".join(f", `__o_{v}` {kinds[v]}" for v in values)
    before = F.broadcast(df.sparkSession.createDataFrame(offsets, schema))

    points = df.groupBy(ref(order).alias(order)).agg(*[F.sum(v).alias(v) for v in values])
    within = (
        Window.partitionBy("__range")
        .orderBy(F.desc(order) if descending else F.asc(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = with_range(points, order, cuts).withColumns({f"__c_{v}": F.sum(v).over(within) for v in values})
    out = summed.join(before, F.col("__range") == F.col("__at")).select(
        order, *values, *[(F.col(f"__c_{v}") + F.col(f"__o_{v}")).alias(f"cum_{v}") for v in values]
    )
    return out, upto


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of the columns pair by pair, null matching null."""
    return reduce(lambda a, b: a & b, [ref(x).eqNullSafe(ref(y)) for x, y in zip(left, right)])


def _values(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """``(by..., v)`` without null and NaN."""
    v = ref(col)
    rows = df.filter(v.isNotNull() & ~F.isnan(v.cast("double")))
    return rows.select(*[ref(b) for b in by], v.alias("v"))


def exact_quantiles(
    df: DataFrame, col: str, shares: Sequence[float], by: Sequence[str] = (), interpolate: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """``(by..., share, value)``: exact quantiles per group, see ``selection.quantiles``.

    ``interpolate`` mixes the two neighbouring values linearly; otherwise the
    smallest value that covers the share is taken. ``ranges`` is the size of a sketch.
    """
    return quantiles(df, [col], shares, by, interpolate, ranges and max(8, ranges)).drop("column")


def box_summary(df: DataFrame, col: str, by: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last values within ``reach`` IQR) and outlier count per group."""
    quartiles = broadcast_small(
        exact_quantiles(df, col, [0.25, 0.5, 0.75], [by])
        .groupBy(ref(by).alias("__by"))
        .agg(
            *[
                F.max(F.when(F.col("share") == s, F.col("value"))).alias(name)
                for s, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
            ]
        )
    )
    rows = _values(df, col, [by]).join(quartiles, _null_safe([by], ["__by"]))
    span = (F.col("q3") - F.col("q1")) * F.lit(reach)
    inside = (F.col("v") >= F.col("q1") - span) & (F.col("v") <= F.col("q3") + span)
    return rows.groupBy(ref(by)).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
