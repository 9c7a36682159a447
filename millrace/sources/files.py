"""File inventories and labelled file lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import normalize_path, path_label
from millrace.sources.listing import list_files

# File endings of pictures, upper case not included.
PICTURE_ENDINGS = (".jpg", ".jpeg", ".png")


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All files below ``path`` with time, length and content.

    Content is only read by plans that use it. Spark leaves out files of length zero; they
    come from a listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    nothing = empty_files(spark, path, glob).withColumn("content", F.lit(bytearray()))
    return reader.load(path).unionByName(nothing)


def empty_files(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files of length zero, as ``(path, modificationTime, length)``, with paths as Spark writes them."""
    found = list_files(spark, path, glob, recursive).filter("length = 0")
    local = F.when(F.col("path").startswith("/"), F.concat(F.lit("file:"), "path")).otherwise(F.col("path"))
    return found.withColumn("path", local)


def list_labeled_files(
    spark: SparkSession,
    root: str,
    classes: Sequence[str],
    endings: Sequence[str] = PICTURE_ENDINGS,
) -> DataFrame:
    """``(path, label_str)`` for one folder per class directly below ``root``, of all files with
    one of the endings, empty ones too; no file is opened."""
    glob = "*{" + ",".join(endings) + "}"
    folders = [f"{root.rstrip('/')}/{name}" for name in classes]
    files = list_files(spark, folders, glob, recursive=False)
    path = normalize_path(F.col("path"))
    return files.select(path.alias("path"), F.element_at(F.split(path, "/"), -2).alias("label_str"))


def filter_classes(df: DataFrame, classes: Sequence[str], path: str = "path") -> DataFrame:
    """Rows whose path has one of the class folders, with its number as ``label``."""
    return df.withColumn("label", path_label(F.col(path), classes)).filter("label >= 0")
