"""Choosing, renaming and dropping columns by their schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The type names that count as numeric.
NUMERIC_TYPES = ("double", "float", "int", "bigint")
# Fixed value: the join key that is never treated as a category.
JOIN_KEY = "name_norm"


def ref(name: str) -> Column:
    """Column by its literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that begins no column of ``df``."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), decimals: bool = False) -> list[str]:
    """Names of the numeric columns; decimals only on request."""
    skip = set(exclude)
    return [
        name
        for name, kind in df.dtypes
        if name not in skip and (kind in NUMERIC_TYPES or (decimals and kind.startswith("decimal")))
    ]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = (JOIN_KEY,)) -> list[str]:
    """Names of the string columns other than the join key."""
    skip = set(exclude)
    return [name for name, kind in df.dtypes if kind == "string" and name not in skip]


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    present = [name for name in names if name in df.columns]
    return df.drop(*present) if present else df


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Drop every copy of a column name that occurs more than once."""
    names = df.columns
    seen = Counter(names)
    if all(n == 1 for n in seen.values()):
        return df
    by_position = df.toDF(*[f"c{i}" for i in range(len(names))])
    return by_position.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names) if seen[name] == 1]
    )


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = (JOIN_KEY,)) -> DataFrame:
    """Prefix every column name except the kept ones."""
    kept = set(keep)
    return df.select(*[ref(c) if c in kept else ref(c).alias(prefix + c) for c in df.columns])


def constant_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with at most one distinct value, null counted as a value. One pass."""
    if not cols:
        return []
    rows = F.count(F.lit(1))
    flags = []
    for i, name in enumerate(cols):
        c = ref(name)
        filled = F.count(c)
        same = F.min(c).eqNullSafe(F.max(c))
        flags.append(((filled == 0) | ((filled == rows) & same)).alias(f"f{i}"))
    row = df.agg(*flags).first()
    return [name for i, name in enumerate(cols) if row[f"f{i}"]]


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop all-null and single-valued columns; a constant with nulls stays."""
    cols = numeric_columns(df) if cols is None else cols
    return drop_if_present(df, constant_columns(df, cols))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.na.drop(subset=list(subset))


def find_target(df: DataFrame, candidates: Sequence[str] = (), contains: str | None = None) -> str:
    """The first candidate that exists, else the first name holding ``contains``."""
    for name in candidates:
        if name in df.columns:
            return name
    if contains:
        for name in df.columns:
            if contains.upper() in name.upper():
                return name
    raise ValueError(f"no target column among {list(candidates)} or containing {contains!r}")


def select_features(df: DataFrame, target: str, drop_derived: bool = True) -> list[str]:
    """Numeric feature columns.

    ``drop_derived`` also leaves out the scaled and binned copies of the target
    (``target_*``), which would give the label away.
    """
    names = numeric_columns(df, exclude=(target,))
    return [n for n in names if not (drop_derived and n.startswith(target + "_"))]
