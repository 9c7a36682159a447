"""Class labels and reproducible splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.functions.scalars import row_key, unit_hash

# Split shares.
TRAIN_TEST = (0.8, 0.2)
TRAIN_VALIDATION_TEST = (0.70, 0.15, 0.15)


def label_above_mean(
    df: DataFrame, target: str, null_target: str = "drop", out: str = "label"
) -> DataFrame:
    """Label 1 where the target is at least its mean, else 0.

    Rows without a target are dropped, or labelled 0 with ``null_target="zero"``.
    """
    if null_target not in ("drop", "zero"):
        raise ValueError(f"unknown policy {null_target!r}")
    mean = df.agg(F.avg(ref(target))).scalar()
    rows = df.na.drop(subset=[target]) if null_target == "drop" else df
    return rows.withColumn(out, F.when(ref(target) >= mean, 1).otherwise(0))


def label_above_mean_sql(df: DataFrame, target: str) -> DataFrame:
    """Same label in SQL text; rows without a target get 0. No view of the session is touched."""
    quoted = "`" + target.replace("`", "``").replace("{", "{{").replace("}", "}}") + "`"
    return df.sparkSession.sql(
        f"SELECT *, CASE WHEN {quoted} >= (SELECT avg({quoted}) FROM {{rows}})"
        " THEN 1 ELSE 0 END AS label FROM {rows}",
        rows=df,
    )


def label_from_bin(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Class number from a bin column; rows without a bin are dropped."""
    return df.na.drop(subset=[col]).withColumn(out, ref(col).cast("int"))


def split_rows(
    df: DataFrame, shares: Sequence[float] = TRAIN_TEST, key: str | None = None, seed: int = 42
) -> list[DataFrame]:
    """Random parts by share.

    With ``key`` a row's part depends on key and seed only: no sort, no
    shuffle, and the same parts however the table is stored. Without it
    Spark's own splitter is used.
    """
    if key is None:
        return df.randomSplit(list(shares), seed=seed)
    numbered = split_number(df, shares, key, seed)
    return [numbered.filter(F.col("__part") == i).drop("__part") for i in range(len(shares))]


def split_number(
    df: DataFrame, shares: Sequence[float], key: str, seed: int = 42, out: str = "__part"
) -> DataFrame:
    """Add the number of the part each row falls in; rows without a key are dealt by content."""
    total, upto = float(sum(shares)), 0.0
    place = unit_hash(row_key(key, df.columns), seed)
    number = F.lit(len(shares) - 1)
    bounds = []
    for share in shares[:-1]:
        upto += share / total
        bounds.append(round(upto, 12))
    for i in reversed(range(len(bounds))):
        number = F.when(place < F.lit(bounds[i]), i).otherwise(number)
    return df.withColumn(out, number)
