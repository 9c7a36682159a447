"""Shared storage for intermediate tables, and size-checked small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import ref

SMALL_ROWS = 10_000
SMALL_TEXT = 1_000
# Bytes that a small table may have at most, whatever its columns.
SMALL_BYTES = 32 << 20

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a temporary folder that
    goes when Python ends.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="millrace-", ignore_cleanup_errors=True)
    return _local_dirs[app].name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; the innermost ``scratch`` scope owns it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope that deletes the tables stored inside it when it ends.

    Write or collect every result that depends on them before.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        context = spark.sparkContext
        for path in paths:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with committed files, so that a lost executor never leads
    to a second, different evaluation of ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _widest(df: DataFrame) -> int:
    """Bytes of a row at most, when no value in it is large."""
    return sum(SMALL_TEXT if kind in ("string", "binary") else 16 for _, kind in df.dtypes)


def collect_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> list[Row] | None:
    """The rows when there are at most ``max_rows`` and no value in them is large, else None.

    Never brings more than ``max_rows + 1`` short rows to the driver, nor more than
    ``SMALL_BYTES``: a table with many columns may have fewer rows. Nested columns
    always count as large.
    """
    max_rows = min(max_rows, SMALL_BYTES // max(1, _widest(df)))
    if any(kind.startswith(("array", "map", "struct", "udt", "vector")) for _, kind in df.dtypes):
        return None
    texts = [ref(c) for c, kind in df.dtypes if kind in ("string", "binary")]
    long = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.octet_length(c) > SMALL_TEXT, F.lit(False)) for c in texts],
        F.lit(False),
    )
    fields = [F.when(~F.col("__long"), ref(c)).alias(c) for c in df.columns]
    checked = df.withColumn("__long", long).select(*fields, "__long").limit(max_rows + 1)
    rows = checked.collect()
    if len(rows) > max_rows or any(r["__long"] for r in rows):
        return None
    return [Row(**{c: r[c] for c in df.columns}) for r in rows]


def broadcast_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """The table as a broadcast local copy when it is small, else as it is."""
    rows = collect_small(df, max_rows)
    if rows is None:
        return df
    local = [tuple(r[c] for c in df.columns) for r in rows]
    return F.broadcast(df.sparkSession.createDataFrame(local, df.schema))
