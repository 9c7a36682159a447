"""Category numbers by frequency, and one-hot arrays.

A short label list (checked) is ranked in one go and broadcast. A long one is
ranked by a distributed sort and joined with hot labels split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.operators.joins import HOT_ROWS, left_join
from millrace.session import collect_small, materialize

SHORT_LIST = 10_000


def label_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(i, label, n)`` for the labels of all columns, by one scan and one shuffle."""
    entries = [F.struct(F.lit(i).alias("i"), ref(c).alias("label")) for i, c in enumerate(cols)]
    each = df.select(F.explode(F.array(*entries)).alias("x")).select("x.*").filter("label is not null")
    return each.groupBy("i", "label").agg(F.count(F.lit(1)).alias("n"))


def label_ranks_of(
    df: DataFrame, cols: Sequence[str], short_list: int = SHORT_LIST
) -> dict[str, tuple[DataFrame, int, bool]]:
    """``label_ranks`` of several columns: counted together, and ranked together.

    The lists come to the driver when all of them together are short. Otherwise one sort ranks
    them all: a label's number is what comes before it in its part, and in the parts before.
    """
    spark, out = df.sparkSession, {}
    kinds: dict[str, list[str]] = {}
    for c in dict.fromkeys(cols):
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for kind, same in kinds.items():
        counts = materialize(label_counts(df, same), "label-counts")
        head = collect_small(counts, short_list * len(same))
        if head is not None:
            for i, c in enumerate(same):
                mine = sorted((r for r in head if r["i"] == i), key=lambda r: (-r["n"], r["label"]))
                rows = [(r["label"], float(k)) for k, r in enumerate(mine)]
                out[c] = (spark.createDataFrame(rows, f"label {kind}, index double"), len(rows), True)
            continue
        # number = labels of the column in earlier sorted parts + place among them in the part
        ranked = counts.orderBy("i", F.desc("n"), F.asc("label"))
        placed = materialize(
            ranked.select(
                "i", "label", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
            ),
            "label-ranks",
        )
        # one row per column and part of the sort; within a part the columns come one after the other
        sizes = placed.groupBy("i", "part").agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("least"))
        before = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("i", "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("least")).alias("start"))
        ranks = placed.join(F.broadcast(starts), ["i", "part"]).select(
            "i", "label", (F.col("start") + F.col("place")).cast("double").alias("index")
        )
        totals = {r["i"]: r["n"] for r in placed.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
        for i, c in enumerate(same):
            out[c] = (ranks.filter(F.col("i") == i).select("label", "index"), totals.get(i, 0), False)
    return out


def label_ranks(df: DataFrame, col: str, short_list: int = SHORT_LIST) -> tuple[DataFrame, int, bool]:
    """``(label, index)`` by falling frequency, ties in label order; with the number of
    labels and whether the list is short enough to broadcast."""
    return label_ranks_of(df, [col], short_list)[col]


def apply_ranks(
    df: DataFrame,
    col: str,
    ranks: DataFrame,
    size: int,
    short: bool,
    invalid: str = "keep",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``col_index``. Null and unseen text: ``keep`` gives the next number,
    ``skip`` drops the row, ``error`` fails."""
    out = f"{col}_index"
    named = ranks.select(F.col("label").alias(col), F.col("index").alias("__index"))
    if short:
        joined = df.join(F.broadcast(named), col, "left")
    else:
        joined = left_join(df, named, col, hot_rows=hot_rows)
    number = F.col("__index")
    if invalid == "keep":
        number = F.coalesce(number, F.lit(float(size)))
    elif invalid == "skip":
        joined = joined.filter("__index is not null")
    elif invalid == "error":
        number = F.coalesce(number, F.raise_error(F.lit(f"null or unseen label in {col}")).cast("double"))
    else:
        raise ValueError(f"unknown policy {invalid!r}")
    return joined.select(*[ref(c) for c in df.columns], number.alias(out))


def string_index(
    df: DataFrame, cols: Sequence[str], invalid: str = "keep", short_list: int = SHORT_LIST
) -> DataFrame:
    """Add ``c_index`` for every column: 0 for the most frequent text."""
    out = df
    for col, (ranks, size, short) in label_ranks_of(df, cols, short_list).items():
        out = apply_ranks(out, col, ranks, size, short, invalid)
    return out


def index_sizes(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Largest index of every ``c_index`` column plus one, in one pass."""
    row = df.agg(*[F.max(ref(f"{c}_index")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: int(row[f"m{i}"] if row[f"m{i}"] is not None else -1) + 1 for i, c in enumerate(cols)}


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    sizes: dict[str, int] | None = None,
    sparse: bool = True,
) -> DataFrame:
    """Add ``c_index_onehot`` from ``c_index``; ``sizes`` counts the known labels.

    The bucket after the last known label is all zeros. A column holds width,
    position and value, or with ``sparse=False`` one array element per label; the
    number of labels never decides which.
    """
    sizes = sizes or index_sizes(df, cols)
    added = []
    for c in cols:
        index, width = ref(f"{c}_index"), sizes[c]
        if sparse:
            known = index < F.lit(float(width))
            hot = F.struct(
                F.lit(width).alias("size"),
                F.when(known, F.array(index.cast("int"))).otherwise(F.array().cast("array<int>")).alias("indices"),
                F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
            )
        elif width == 0:
            hot = F.array().cast("array<double>")
        else:
            hot = F.transform(
                F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i == index, 1.0).otherwise(0.0)
            )
        added.append(hot.alias(f"{c}_index_onehot"))
    return df.select("*", *added)


def encode(
    df: DataFrame, cols: Sequence[str], invalid: str = "keep", sparse: bool = True
) -> DataFrame:
    """Index and one-hot columns, ranking every label list once."""
    out, sizes = df, {}
    for col, (ranks, size, short) in label_ranks_of(df, cols).items():
        sizes[col] = size
        out = apply_ranks(out, col, ranks, size, short, invalid)
    return one_hot(out, cols, sizes, sparse) if cols else out
