"""Column statistics, group shares, correlation, covariance, principal components."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import drop_if_present, numeric_columns, ref

# Pruning and variance limits.
CORRELATION_LIMIT = 0.85
VARIANCE_SHARE = 0.95
# Projections with more terms than this go through vectors; the results are the same.
PROJECTION_TERMS = 1_000
# A sum of squared deviations below this share of the sum of squares is rounding noise.
NO_SPREAD = 1e-12


def column_stats(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column, n, n_distinct, mean, stddev, min, max)`` for numeric columns.

    Everything but the exact distinct counts comes from one pass, those of all columns
    together from a second one; ``approx`` replaces them by sketches in the first.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    aggs, entries = [], []
    for i, name in enumerate(cols):
        c = ref(name)
        parts = {
            "n": F.count(c),
            "mean": F.avg(c),
            "stddev": F.stddev(c),
            "min": F.min(c).cast("double"),
            "max": F.max(c).cast("double"),
        }
        if approx:
            parts["n_distinct"] = F.approx_count_distinct(c)
        aggs += [agg.alias(f"{k}{i}") for k, agg in parts.items()]
        entries.append(
            F.struct(F.lit(name).alias("column"), *[F.col(f"{k}{i}").alias(k) for k in parts])
        )
    stats = df.agg(*aggs).select(F.inline(F.array(*entries)))
    if not approx:
        stats = stats.join(distinct_counts(df, cols), "column")
    return stats.select("column", "n", "n_distinct", "mean", "stddev", "min", "max")


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n_distinct)``: exact, null not counted, all columns by one scan and one shuffle
    of different values. Columns of one type are compared in it; each type has a field of its own."""
    kinds = sorted({df.schema[c].dataType.simpleString() for c in cols})
    fields = {k: f"v{i}" for i, k in enumerate(kinds)}
    entries = []
    for i, c in enumerate(cols):
        own = df.schema[c].dataType.simpleString()
        values = [(ref(c) if k == own else F.lit(None).cast(k)).alias(f) for k, f in fields.items()]
        entries.append(F.when(ref(c).isNotNull(), F.struct(F.lit(i).alias("i"), *values)))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, column string")
    if not cols:
        return names.select("column", F.lit(0).cast("bigint").alias("n_distinct"))
    each = df.select(F.explode(F.array(*entries)).alias("x")).filter("x is not null").select("x.*").distinct()
    counts = each.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(names).join(counts, "i", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def group_sizes(df: DataFrame, col: str) -> DataFrame:
    """``(col, n, pct)``: rows per group and their share of all rows, by group."""
    counts = df.groupBy(ref(col).alias(col)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total).orderBy(col)


def _clean_double(name: str):
    c = ref(name).cast("double")
    return F.when(~F.isnan(c), c)


#: Columns of a tile's side, and bytes of tiles that a task adds up at a time.
TILE, TILES_BYTES = 128, 64 << 20


class Tile:
    """Sums over the rows for one block of columns against another: of rows in which both columns
    are known, the number, the sums and squares of either side, and the products."""

    def __init__(self, height: int, width: int):
        self.rows = 0
        self.left, self.right = np.zeros((2, height)), np.zeros((2, width))
        self.product = np.zeros((height, width))
        # Where no value is missing these follow from the above.
        self.masked: np.ndarray | None = None

    def add(self, x: np.ndarray, y: np.ndarray, known_x: np.ndarray | None, known_y: np.ndarray | None) -> None:
        self.product += x.T @ y
        if known_x is None and known_y is None:
            self.rows += len(x)
            self.left += [x.sum(0), (x * x).sum(0)]
            self.right += [y.sum(0), (y * y).sum(0)]
            return
        kx = np.ones_like(x) if known_x is None else known_x
        ky = np.ones_like(y) if known_y is None else known_y
        if self.masked is None:
            self.masked = np.zeros((5, *self.product.shape))
        self.masked += np.stack([kx.T @ ky, x.T @ ky, kx.T @ y, (x * x).T @ ky, kx.T @ (y * y)])

    def lines(self) -> np.ndarray:
        """``[row of the tile, sum, column]`` in the order of ``PAIR_SUMS``."""
        full = np.broadcast_to
        shape = self.product.shape
        out = np.stack([
            full(float(self.rows), shape), full(self.left[0][:, None], shape), full(self.right[0], shape),
            full(self.left[1][:, None], shape), full(self.right[1], shape), self.product,
        ])
        if self.masked is not None:
            out[:5] += self.masked
        return out.transpose(1, 0, 2)


PAIR_SUMS = ("n", "si", "sj", "qi", "qj", "p")


def _tile_passes(width: int, gaps: Sequence[bool]) -> list[list[tuple[int, int]]]:
    """The tiles on and above the diagonal, in groups that a task can add up at a time."""
    blocks = -(-width // TILE)
    holed = [any(gaps[b * TILE : (b + 1) * TILE]) for b in range(blocks)]
    passes, room = [], 0
    for i in range(blocks):
        for j in range(i, blocks):
            size = TILE * TILE * 8 * (6 if holed[i] or holed[j] else 1)
            if size > room:
                passes.append([])
                room = TILES_BYTES
            passes[-1].append((i, j))
            room -= size
    return passes


def _tile_sums(named: DataFrame, tiles: list[tuple[int, int]], center: Sequence[float], width: int) -> DataFrame:
    """``(i, tile, line)`` of each task: the packed sums of column ``i`` against those of a block."""
    used = sorted({b for t in tiles for b in t})
    spans = {b: (b * TILE, min(width, (b + 1) * TILE)) for b in used}
    columns = [c for b in used for c in range(*spans[b])]
    middle = {b: np.array(center[slice(*spans[b])]) for b in used}

    def run(batches):
        held = {t: Tile(*(spans[b][1] - spans[b][0] for b in t)) for t in tiles}
        for batch in batches:
            blocks, at = {}, 0
            for b in used:
                n = spans[b][1] - spans[b][0]
                x = np.stack([batch.column(at + c).to_numpy(zero_copy_only=False) for c in range(n)], 1) - middle[b]
                at += n
                known = np.isfinite(x)
                blocks[b] = (x, None) if known.all() else (np.where(known, x, 0.0), known.astype(float))
            for (i, j), tile in held.items():
                tile.add(blocks[i][0], blocks[j][0], blocks[i][1], blocks[j][1])
        for (i, j), tile in held.items():
            lines = tile.lines()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(*spans[i]), pa.int32()), pa.array([j] * len(lines), pa.int32()),
                 pa.array([np.ascontiguousarray(x).tobytes() for x in lines], pa.binary())],
                ["i", "tile", "line"],
            )

    return named.select(*[f"x{c}" for c in columns]).mapInArrow(run, "i int, tile int, line binary")


def _added(parts: DataFrame) -> DataFrame:
    """``(i, j)`` and the sums of ``PAIR_SUMS``, from the packed lines of all tasks; a task adds one
    line after the other and holds one."""

    def run(batches):
        key, total = None, None

        def told():
            i, tile = key
            n = total.shape[1]
            j = tile * TILE + np.arange(n)
            use = j >= i
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(use.sum(), i, np.int32)), pa.array(j[use].astype(np.int32)), *[pa.array(x[use]) for x in total]],
                ["i", "j", *PAIR_SUMS],
            )

        for batch in batches:
            for i, tile, line in zip(*(batch.column(c).to_pylist() for c in range(3))):
                values = np.frombuffer(line).reshape(len(PAIR_SUMS), -1)
                if (i, tile) == key:
                    total += values
                    continue
                if key is not None:
                    yield told()
                key, total = (i, tile), values.copy()
        if key is not None:
            yield told()

    ordered = parts.repartition("i", "tile").sortWithinPartitions("i", "tile")
    return ordered.mapInArrow(run, "i int, j int, " + ", ".join(f"{k} double" for k in PAIR_SUMS))


def _pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(i, j, n, co, vi, vj)``: co-moment sums of all column pairs i <= j over complete rows.

    Columns are cut into blocks; a task adds up tiles of one block against another by matrix
    products, at most ``TILES_BYTES`` of them, so wide tables are read several times rather than
    held whole. A tile's line of one column is one packed row. Values are centred first, so that
    large means cost no precision; what is missing is only tracked in tiles with gaps.
    """
    named = df.select(*[_clean_double(c).alias(f"x{i}") for i, c in enumerate(cols)])
    finite = lambda c: F.when(F.abs(c) != float("inf"), F.col(c))
    row = named.agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(finite(f"x{i}")).alias(f"m{i}") for i in range(len(cols))],
        *[F.count(finite(f"x{i}")).alias(f"n{i}") for i in range(len(cols))],
    ).first()
    width = len(cols)
    center = [row[f"m{i}"] or 0.0 for i in range(width)]
    gaps = [row[f"n{i}"] < row["rows"] for i in range(width)]
    parts = [_tile_sums(named, tiles, center, width) for tiles in _tile_passes(width, gaps)]
    total = _added(reduce(DataFrame.unionByName, parts))
    n = F.nullif(F.col("n"), F.lit(0.0))

    def spread(q: str, s: str):
        v = F.col(q) - F.col(s) * F.col(s) / n
        return F.when(v.isNull(), None).when(v > NO_SPREAD * F.col(q), v).otherwise(0.0)

    return total.select(
        "i",
        "j",
        F.col("n").cast("bigint").alias("n"),
        (F.col("p") - F.col("si") * F.col("sj") / n).alias("co"),
        spread("qi", "si").alias("vi"),
        spread("qj", "sj").alias("vj"),
    )


def _named_pairs(pairs: DataFrame, cols: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in cols])
    return pairs.withColumns(
        {"col_i": F.get(names, F.col("i")), "col_j": F.get(names, F.col("j"))}
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(col_i, col_j, corr)``: absolute Pearson correlation of all pairs i < j.

    Each pair uses the rows where both are present; NaN and infinite values count
    as missing. Null, never NaN, where a column has no spread on those rows.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    scale = F.nullif(F.sqrt(F.col("vi")) * F.sqrt(F.col("vj")), F.lit(0.0))
    pairs = _pair_sums(df, cols).filter("i < j")
    return _named_pairs(pairs, cols).select(
        "col_i", "col_j", F.abs(F.col("co") / scale).alias("corr")
    )


def covariance_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(col_i, col_j, cov)``: sample covariance of all pairs i <= j."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return _named_pairs(_pair_sums(df, cols), cols).select(
        "col_i", "col_j", (F.col("co") / F.nullif(F.col("n") - 1, F.lit(0))).alias("cov")
    )


def redundant_columns(
    df: DataFrame, cols: Sequence[str] | None = None, limit: float = CORRELATION_LIMIT
) -> list[str]:
    """Columns that correlate above ``limit`` with any column before them."""
    cols = numeric_columns(df) if cols is None else list(cols)
    if len(cols) < 2:
        return []
    pairs = correlation_matrix(df, cols).filter("corr is not null and not isnan(corr)")
    hits = pairs.filter(F.col("corr") > limit).select("col_j").distinct()
    found = {row[0] for row in hits.collect()}
    return [c for c in cols if c in found]


def prune_correlated(
    df: DataFrame, cols: Sequence[str] | None = None, limit: float = CORRELATION_LIMIT
) -> DataFrame:
    """Drop the later column of every pair above ``limit``, also when the earlier one goes too."""
    return drop_if_present(df, redundant_columns(df, cols, limit))


def pca_fit(df: DataFrame, cols: Sequence[str], k: int | None = None) -> PCAModel:
    """Principal components of the columns; fill missing values first."""
    vectors = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="error")
    rows = vectors.transform(df.select(*[ref(c).cast("double").alias(c) for c in cols]))
    return PCA(k=k or len(cols), inputCol="__features", outputCol="__scores").fit(rows)


def pca_keep(ratios: Sequence[float], share: float = VARIANCE_SHARE) -> int:
    """Smallest number of components that explain ``share``, or all."""
    total = 0.0
    for i, r in enumerate(ratios):
        total += r
        if total >= share:
            return i + 1
    return len(ratios)


def pca_variance(df: DataFrame, model: PCAModel, share: float = VARIANCE_SHARE) -> DataFrame:
    """``(component, ratio, cumulative, kept)``, one row per component."""
    ratios = [float(r) for r in model.explainedVariance.toArray()]
    keep = pca_keep(ratios, share)
    rows, total = [], 0.0
    for i, r in enumerate(ratios):
        total += r
        rows.append((i + 1, r, total, i < keep))
    return df.sparkSession.createDataFrame(
        rows, "component int, ratio double, cumulative double, kept boolean"
    )


def pca_project(
    df: DataFrame, cols: Sequence[str], model: PCAModel | None = None, k: int | None = None
) -> DataFrame:
    """Add ``PC1..PCk``; rows are not centred. ``k`` defaults to the 95 % rule.

    A null in any of the columns makes all components of the row null.

    A moderate number of terms is written as plain sums, which stay in generated
    code; wide projections go through the model's vectors.
    """
    model = model or pca_fit(df, cols)
    k = k or pca_keep([float(r) for r in model.explainedVariance.toArray()])
    if len(cols) * k <= PROJECTION_TERMS:
        weights = model.pc.toArray()
        scores = [
            reduce(add, [ref(c).cast("double") * F.lit(float(weights[i, j])) for i, c in enumerate(cols)])
            for j in range(k)
        ]
        return df.select("*", *[s.alias(f"PC{j + 1}") for j, s in enumerate(scores)])
    vectors = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="keep")
    scored = model.transform(vectors.transform(df)).withColumn(
        "__array", vector_to_array(F.col("__scores"))
    )
    whole = reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in cols])
    return scored.select(
        *[ref(c) for c in df.columns],
        *[F.when(whole, F.get(F.col("__array"), F.lit(i))).alias(f"PC{i + 1}") for i in range(k)],
    )
