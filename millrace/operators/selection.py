"""Exact quantiles of many columns and groups at once.

A first reading takes one mergeable quantile sketch per column and group, all in one
aggregate. The sketch says between which two values each wanted rank must lie; a second
reading counts what lies below each such range and keeps the values inside, for all columns
together. The ranks are then exact counts. Of tables so large that a range would still hold
millions of values, further readings narrow the ranges first. A sketch may err: a rank that is
found outside its range is looked for again in a wider one, in the end in all values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import broadcast_small, materialize

#: Size of a sketch without and with groups.
SIZE, GROUP_SIZE = 4_096, 512
#: Published error of a rank, as a share of all rows: ``ERROR / size ** POWER``; ranges are three
#: times as wide to either side.
ERROR, POWER, WIDER = 2.296, 0.9021, 3.0
#: Values of a range, beyond which a further reading narrows it before its values are kept.
KEPT = 4_000_000
NARROWINGS = 4


def rank_error(size: int) -> float:
    """Share of the rows to either side of a rank that its range covers."""
    return min(1.0, WIDER * ERROR / size**POWER)


def _number(c: str) -> Column:
    """The column as a double, null and NaN as null; both zeros are one value."""
    x = ref(c).cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [ref(x).eqNullSafe(ref(y)) for x, y in zip(left, right)], F.lit(True))


def sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), size: int | None = None) -> DataFrame:
    """``(by..., column, n, sketch)``: number of the column and its values, in one aggregate."""
    size = size or (GROUP_SIZE if by else SIZE)
    keys = [f"__b{i}" for i in range(len(by))]
    rows = df.select(*[ref(b).alias(k) for b, k in zip(by, keys)], *[_number(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    aggs = []
    for i in range(len(cols)):
        aggs += [F.count(f"__v{i}").alias(f"n{i}"), F.expr(f"kll_sketch_agg_double(__v{i}, {size})").alias(f"s{i}")]
    found = rows.groupBy(*keys).agg(*aggs)
    each = F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch")) for i in range(len(cols))
    ]))
    return found.select(*keys, each.alias("x")).select(*keys, "x.*").filter("n > 0")


def _picks(n: Column, share: Column, interpolate: bool) -> tuple[list[Column], Column]:
    """Ranks from 0 of the values that a share asks for, and the weight of the second."""
    if interpolate:
        at = share * (n - 1)
        return [F.floor(at), F.ceil(at)], at - F.floor(at)
    return [F.greatest(F.ceil(share * n) - 1, F.lit(0))], F.lit(0.0)


def _steps(error: float) -> int:
    """Steps of the grid of ranks at which a sketch is asked: finer than its error."""
    return min(4_096, max(8, int(4 / error)))


def _grid(sketch: str, error: float) -> Column:
    """Values at evenly spaced ranks from the least to the largest, all from one look."""
    steps = _steps(error)
    ranks = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    return F.call_function("kll_sketch_get_quantile_double", F.col(sketch), ranks)


def _bounds(grid: str, rank: Column, error: float) -> tuple[Column, Column]:
    """Values of the grid between which a rank, as a share from 0 to 1, lies."""
    steps = _steps(error)
    low, high = F.floor((rank - F.lit(error)) * steps).cast("int"), F.ceil((rank + F.lit(error)) * steps).cast("int")
    lo = F.when(low > 0, F.get(F.col(grid), low)).otherwise(F.lit(float("-inf")))
    hi = F.when(high < steps, F.get(F.col(grid), high)).otherwise(F.lit(float("inf")))
    return lo, hi


def wanted_ranks(found: DataFrame, shares: Sequence[float], interpolate: bool, error: float) -> DataFrame:
    """``(by..., column, share, weight, pick, lo, hi, held)``: each wanted rank, the range of
    values that it lies in, and about how many values that range holds."""
    share = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    keys = [c for c in found.columns if c.startswith("__b")]
    rows = found.select(*keys, "column", "n", _grid("sketch", error).alias("grid")).select("*", share)
    picks, weight = _picks(F.col("n"), F.col("share"), interpolate)
    rows = rows.select("*", weight.alias("weight"), F.explode(F.array_distinct(F.array(*picks))).alias("pick"))
    lo, hi = _bounds("grid", F.col("pick") / F.greatest(F.col("n") - 1, F.lit(1)), error)
    held = (F.col("n") * min(1.0, 3 * error)).alias("held")
    return rows.select(*keys, "column", "share", "weight", "pick", lo.alias("lo"), hi.alias("hi"), held)


def _ranged(wanted: DataFrame) -> DataFrame:
    """``wanted`` with the number ``range`` of the range, overlapping ones merged, in its column."""
    keys = [c for c in wanted.columns if c.startswith("__b")]
    by = Window.partitionBy(*keys, "column").orderBy("lo", "hi", "share", "pick")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    starts = wanted.withColumn("new", F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0))
    return starts.withColumn("range", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("new")


def _placed(df: DataFrame, cols: Sequence[str], by: Sequence[str], wanted: DataFrame, most: int):
    """The rows with the ends of their group's ranges: ``__b<number>``, ``__c<column>``, and a
    function that gives ``l<column>_<range>`` and ``h<column>_<range>``; unused ones are null."""
    keys, theirs = [f"__b{i}" for i in range(len(by))], [f"__t{i}" for i in range(len(by))]
    merged = _ranged(wanted).groupBy(*keys, "column", "range").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    of = lambda i, j, c: F.max(F.when((F.col("column") == i) & (F.col("range") == j), F.col(c)))
    ends = [(i, j) for i in range(len(cols)) for j in range(most)]
    cells = [of(i, j, "lo").alias(f"l{i}_{j}") for i, j in ends] + [of(i, j, "hi").alias(f"h{i}_{j}") for i, j in ends]
    ranges = merged.groupBy(*keys).agg(*cells)
    rows = df.select(*[ref(b).alias(k) for b, k in zip(by, keys)], *[ref(c).alias(f"__c{i}") for i, c in enumerate(cols)])
    numbers = {f"__v{i}": _number(f"__c{i}") for i in range(len(cols))}
    if by:
        ranges = broadcast_small(ranges.withColumnsRenamed(dict(zip(keys, theirs))))
        return rows.join(ranges, _null_safe(keys, theirs)).withColumns(numbers), F.col
    found = ranges.first()
    values = {} if found is None else found.asDict()
    return rows.withColumns(numbers), lambda name: F.lit(values.get(name)).cast("double")


def narrowed(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], wanted: DataFrame, most: int, error: float, size: int
) -> DataFrame:
    """``wanted`` with ranges that hold about ``3 * error`` of what they held: one further reading
    counts the values below each range and sketches those inside."""
    keys = [f"__b{i}" for i in range(len(by))]
    rows, edge = _placed(df, cols, by, wanted, most)
    aggs, told = [], []
    for i in range(len(cols)):
        for j in range(most):
            x, at = F.col(f"__v{i}"), f"{i}_{j}"
            inside = (x >= edge(f"l{at}")) & (x <= edge(f"h{at}"))
            rows = rows.withColumn(f"x{at}", F.when(inside, x))
            aggs += [
                F.count_if(x < edge(f"l{at}")).alias(f"b{at}"), F.count(f"x{at}").alias(f"m{at}"),
                F.expr(f"kll_sketch_agg_double(x{at}, {size})").alias(f"s{at}"),
            ]
            told.append(F.struct(
                F.lit(i).alias("column"), F.lit(j).cast("bigint").alias("range"), F.col(f"b{at}").alias("below"),
                F.col(f"m{at}").alias("inside"), F.col(f"s{at}").alias("sketch"),
            ))
    found = rows.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*told)).alias("x")).select(*keys, "x.*")
    theirs = [f"__t{i}" for i in range(len(by))]
    found = found.filter("inside > 0").withColumn("grid", _grid("sketch", error)).withColumnsRenamed({**dict(zip(keys, theirs)), "column": "__tc", "range": "__tr"})
    same = (F.col("column") == F.col("__tc")) & (F.col("range") == F.col("__tr")) & _null_safe(keys, theirs)
    joined = _ranged(wanted).join(found, same, "left")
    hit = F.coalesce((F.col("pick") >= F.col("below")) & (F.col("pick") < F.col("below") + F.col("inside")), F.lit(False))
    lo, hi = _bounds("grid", (F.col("pick") - F.col("below")) / F.greatest(F.col("inside") - 1, F.lit(1)), error)
    # A rank outside of its range keeps it: the last reading sees that, and takes a wider one.
    return joined.select(
        *keys, "column", "share", "weight", "pick", F.when(hit, F.greatest("lo", lo)).otherwise(F.col("lo")).alias("lo"),
        F.when(hit, F.least("hi", hi)).otherwise(F.col("hi")).alias("hi"),
        F.when(hit, F.col("inside") * min(1.0, 3 * error)).otherwise(F.lit(0.0)).alias("held"),
    )


def counted(df: DataFrame, cols: Sequence[str], by: Sequence[str], wanted: DataFrame, most: int) -> DataFrame:
    """``(by..., column, code, v, c)``: how many values lie below, between and behind the ranges
    (even codes, null value), and how often each value inside a range occurs (odd codes)."""
    keys = [f"__b{i}" for i in range(len(by))]
    kinds = {df.schema[c].dataType.simpleString() for c in cols}
    kind = kinds.pop() if len(kinds) == 1 else "double"
    rows, edge = _placed(df, cols, by, wanted, most)
    entries = []
    for i in range(len(cols)):
        x = F.col(f"__v{i}")
        code = reduce(
            lambda a, b: a + b,
            [F.when(x >= edge(f"l{i}_{j}"), 1).otherwise(0) + F.when(x > edge(f"h{i}_{j}"), 1).otherwise(0) for j in range(most)],
        )
        raw = F.col(f"__c{i}").cast(kind)
        # Both zeros are one value.
        raw = raw + F.lit(0.0).cast(kind) if kind in ("double", "float") else raw
        inside = F.when(code % 2 == 1, raw)
        entries.append(F.struct(F.lit(i).alias("column"), code.alias("code"), inside.alias("v"), x.isNotNull().alias("use")))
    each = rows.select(*keys, F.explode(F.array(*entries)).alias("x")).select(*keys, "x.*").filter("use")
    return each.groupBy(*keys, "column", "code", "v").agg(F.count(F.lit(1)).alias("c"))


def quantiles(
    df: DataFrame, cols: Sequence[str], shares: Sequence[float], by: Sequence[str] = (), interpolate: bool = True,
    size: int | None = None,
) -> DataFrame:
    """``(by..., column, share, value)``: exact quantiles of every column, in two readings.

    Null and NaN have no rank; a column without values, or a group without any, has no row.
    ``interpolate`` mixes the two neighbouring values linearly; otherwise the smallest value
    that covers the share is taken. Columns of one type keep it, mixed ones become doubles.
    ``column`` is the column's name.
    """
    cols, by = list(cols), list(by)
    keys = [f"__b{i}" for i in range(len(by))]
    size = size or (GROUP_SIZE if by else SIZE)
    found = materialize(sketches(df, cols, by, size), "quantile-sketches")
    error = rank_error(size)
    most = len(set(shares)) * (2 if interpolate else 1)
    while True:
        wanted = materialize(wanted_ranks(found, sorted(set(shares)), interpolate, error), "wanted-ranks")
        # Only where a range holds too much for one task. A few values that occur very often
        # cannot be parted, and need not be: each is one row with its count.
        for _ in range(NARROWINGS):
            if error >= 0.25 or wanted.filter((F.col("held") > KEPT) & (F.col("lo") < F.col("hi"))).isEmpty():
                break
            wanted = materialize(narrowed(df, cols, by, wanted, most, error, size), "wanted-ranks")
        counts = counted(df, cols, by, wanted, most)
        upto = F.sum("c").over(
            Window.partitionBy(*keys, "column").orderBy("code", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        placed = counts.withColumn("upto", upto).withColumnsRenamed({k: f"__p{i}" for i, k in enumerate(keys)})
        placed = placed.withColumnRenamed("column", "__pc")
        ours = [f"__p{i}" for i in range(len(keys))]
        same = (F.col("column") == F.col("__pc")) & _null_safe(keys, ours)
        within = (F.col("pick") >= F.col("upto") - F.col("c")) & (F.col("pick") < F.col("upto"))
        hits = placed.join(broadcast_small(wanted.drop("lo", "hi", "held")), same & within)
        hits = materialize(hits.select(*keys, "column", "share", "weight", "pick", "code", "v"), "quantile-hits")
        if error >= 1.0 or hits.filter("code % 2 = 0").isEmpty():
            break
        error = min(1.0, 8 * error)
    low, high = F.min_by("v", "pick"), F.max_by("v", "pick")
    value = low + (high - low) * F.first("weight") if interpolate else low
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column") + 1)
    out = hits.groupBy(*keys, "column", "share").agg(value.alias("value"))
    return out.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], names.alias("column"), "share", "value")
