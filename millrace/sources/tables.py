"""Reading, writing and profiling tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import ref


def read_table(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None
) -> DataFrame:
    """Read a file, a directory or a glob of part files.

    CSV has a header. Give a schema where it is known: inference costs one
    more pass over the text.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write a table. CSV has a header; vectors and nested values become JSON text there."""
    if fmt == "csv":
        df = df.select(*[_csv_safe(f) for f in df.schema.fields])
    else:
        df = df.select(*[_plain(f) for f in df.schema.fields])
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_text(spark: SparkSession, text: str, path: str, mode: str = "overwrite") -> None:
    """Write a short report as one text file below ``path``."""
    lines = spark.createDataFrame([(text.rstrip("\n"),)], "value string")
    lines.coalesce(1).write.mode(mode).text(path)


def _plain(field: T.StructField):
    if field.dataType.typeName() == "vectorudt" or "VectorUDT" in type(field.dataType).__name__:
        return vector_to_array(ref(field.name)).alias(field.name)
    return ref(field.name)


def _csv_safe(field: T.StructField):
    plain = _plain(field)
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    if nested or "VectorUDT" in type(field.dataType).__name__:
        return F.to_json(plain).alias(field.name)
    return plain


def profile(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def profile_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row and column counts of two versions of a table, one row each."""
    return (
        profile(before)
        .withColumn("version", F.lit("before"))
        .unionByName(profile(after).withColumn("version", F.lit("after")))
        .select("version", "n_rows", "n_columns")
    )


def preview(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*[ref(c) for c in (order_by or df.columns)]).limit(n)
