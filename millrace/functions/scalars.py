"""Scalar expressions on single columns; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms and constants that decide results.
FEET_INCHES = "^[0-9]+-[0-9]+$"
PLAIN_NUMBER = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"
CM_PER_INCH = 2.54
INCHES_PER_FOOT = 12
UNKNOWN_TEXT = "Unknown"
UNKNOWN_DATE = "1900-01-01"
DASH_SUFFIX = "-.*"
EDGE_SPACE = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"


def parse_length_inches(col: Column) -> Column:
    """Inches from ``feet-inches`` text or from a number of centimetres, else null.

    Centimetres are rounded half to even.
    """
    text = col.cast("string")
    parts = F.split(text, "-")
    feet = F.get(parts, F.lit(0)).try_cast("double")
    feet_inches = (feet * INCHES_PER_FOOT + F.get(parts, F.lit(1)).try_cast("double")).try_cast("int")
    bare = F.regexp_replace(text, EDGE_SPACE, "")
    number = F.when(
        bare.rlike(PLAIN_NUMBER) & (F.size(parts) <= 2),
        F.regexp_replace(bare, "_", "").try_cast("double"),
    )
    inches = F.bround(number / F.lit(CM_PER_INCH)).try_cast("int")
    return F.when(text.rlike(FEET_INCHES), feet_inches).otherwise(inches)


def normalize_key(col: Column) -> Column:
    """Lower-cased text without edge white space; null and empty text give null."""
    return F.when(col != "", F.regexp_replace(F.lower(col), EDGE_SPACE, ""))


def strip_suffix(col: Column, pattern: str = DASH_SUFFIX) -> Column:
    """Text before the first match of ``pattern``."""
    return F.regexp_replace(col, pattern, "")


def fill_date(col: Column, default: str = UNKNOWN_DATE) -> Column:
    """Missing dates replaced by a default."""
    return F.coalesce(col, F.to_date(F.lit(default)))


def unit_hash(key: Column, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def row_key(key: str, columns: Sequence[str]) -> Column:
    """The key as text; rows without one get a key made of the whole row."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    own = F.concat(F.lit("null:"), F.xxhash64(F.to_json(F.struct(*quoted))).cast("string"))
    return F.coalesce(F.col("`" + key.replace("`", "``") + "`").cast("string"), own)


def argmax_class(scores: Column) -> Column:
    """Position of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def normalize_path(path: Column) -> Column:
    """Path without a leading ``file:`` scheme."""
    return F.regexp_replace(path, "^file:", "")


def path_label(path: Column, classes: Sequence[str], mode: str = "segment") -> Column:
    """Class number of a path.

    ``segment``: position of the first class that is a folder on the path, -1
    when none is. ``substring``: 0 when the first class occurs anywhere in the
    path, else 1.
    """
    text = F.lower(path)
    if mode == "substring":
        return F.when(text.contains(classes[0].lower()), 0).otherwise(1)
    if mode != "segment":
        raise ValueError(f"unknown mode {mode!r}")
    found = [F.when(text.contains(f"/{name.lower()}/"), i) for i, name in enumerate(classes)]
    return F.coalesce(*found, F.lit(-1))


def scale_pixels(pixels: Column, by: float = 255.0) -> Column:
    """Every element divided by ``by``."""
    return F.transform(pixels, lambda x: x.cast("double") / F.lit(float(by)))


def reshape_pixels(pixels: Column, height: int, width: int) -> Column:
    """Flat pixels as ``height`` rows of ``width`` values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(height - 1)),
        lambda i: F.slice(pixels, i * width + 1, F.lit(width)),
    )
