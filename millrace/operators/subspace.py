"""The first principal components of wide tables, by block subspace iteration.

The driver holds as many numbers as columns times components; no task and no driver ever sees
the square of the columns. Each reading multiplies the table with a block of directions and
back, ``X' (X Q)``, in one product per batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize

#: Further directions that are carried along, the most readings, and the relative change of the
#: components' variances at which they have settled.
MORE, READINGS, SETTLED = 10, 30, 1e-10


@dataclass
class Components:
    """``pc`` holds a component in each column; ``ratios`` are their shares of all variance;
    ``readings`` is how often the table was read."""

    cols: list[str]
    pc: np.ndarray
    ratios: list[float]
    readings: int


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[ref(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])


def _matrix(batch: pa.RecordBatch, center: np.ndarray) -> np.ndarray:
    x = np.empty((batch.num_rows, len(center)))
    for i in range(len(center)):
        x[:, i] = batch.column(i).to_numpy(zero_copy_only=False)
    if not np.isfinite(x).all():
        raise ValueError("components need complete, finite rows: fill missing values first")
    return x - center


def _products(rows: DataFrame, center: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``X' X Q`` and ``(X Q)' (X Q)`` of the centred rows; a task gives one packed row."""

    def run(batches):
        back, own = np.zeros_like(q), np.zeros((q.shape[1], q.shape[1]))
        for batch in batches:
            # Several products of bounded size, whatever the batch holds.
            for at in range(0, batch.num_rows, 1_024):
                x = _matrix(batch.slice(at, 1_024), center)
                y = x @ q
                back += x.T @ y
                own += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([back.tobytes()]), pa.array([own.tobytes()])], ["back", "own"])

    back, own = np.zeros_like(q), np.zeros((q.shape[1], q.shape[1]))
    for r in rows.mapInArrow(run, "back binary, own binary").toLocalIterator():
        back += np.frombuffer(r["back"]).reshape(back.shape)
        own += np.frombuffer(r["own"]).reshape(own.shape)
    return back, own


def pca_top(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, readings: int = READINGS) -> Components:
    """The ``k`` components with most variance, signs so that the largest weight is positive.

    Iterated until their variances settle to ``SETTLED``, at most ``readings`` times; equal to
    the exact ones up to that where the variances behind the ``MORE`` further directions are
    smaller. With ``k + MORE`` directions or more than columns it is exact after one reading.
    Null, NaN and infinite values fail; a table of fewer than two rows has no components.
    """
    cols = list(cols)
    stored = materialize(_numbers(df, cols), "component-rows")
    found = stored.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(stored.columns)],
                       *[F.variance(c).alias(f"v{i}") for i, c in enumerate(stored.columns)]).first()
    n, p = found["n"], len(cols)
    if n < 2:
        raise ValueError("components need at least two rows")
    center = np.array([found[f"m{i}"] if found[f"m{i}"] is not None else 0.0 for i in range(p)])
    total = sum(found[f"v{i}"] or 0.0 for i in range(p))
    width = min(p, k + MORE)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, width)))
    last, values, vectors = None, np.zeros(width), q
    for step in range(1, readings + 1):
        back, own = _products(stored, center, q)
        # Rayleigh and Ritz: the best components within the space of the directions.
        values, turn = np.linalg.eigh(own / (n - 1))
        values, vectors = values[::-1], q @ turn[:, ::-1]
        top = values[:k]
        if width == p or (last is not None and np.abs(top - last).max() <= SETTLED * max(top[0], 1e-300)):
            break
        last = top
        q, _ = np.linalg.qr(back)
    pc = vectors[:, : min(k, p)]
    pc = pc * np.where(pc[np.abs(pc).argmax(0), np.arange(pc.shape[1])] < 0, -1.0, 1.0)
    ratios = [float(max(v, 0.0) / total) if total > 0 else 0.0 for v in values[: min(k, p)]]
    return Components(cols, pc, ratios, step)


def project_top(df: DataFrame, found: Components) -> DataFrame:
    """Add ``PC1..PCk``; rows are not centred. A null in any of the columns makes all of them null."""
    kept, k = [f.name for f in df.schema.fields], found.pc.shape[1]
    weights, names = found.pc, [f"PC{i + 1}" for i in range(found.pc.shape[1])]

    def run(batches):
        for batch in batches:
            x = np.empty((batch.num_rows, len(weights)))
            for i in range(len(weights)):
                x[:, i] = batch.column(len(kept) + i).to_numpy(zero_copy_only=False)
            whole = np.ones(batch.num_rows, bool)
            for i in range(len(weights)):
                whole &= np.asarray(batch.column(len(kept) + i).is_valid())
            scores = np.where(whole[:, None], x, 0.0) @ weights
            out = [pa.array(scores[:, j], mask=~whole) for j in range(k)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *out], [*kept, *names])

    numbers = [ref(c).cast("double").alias(f"__x{i}") for i, c in enumerate(found.cols)]
    wide = df.select(*[ref(c) for c in kept], *numbers)
    schema = df.select("*", *[F.lit(None).cast("double").alias(c) for c in names]).schema
    return wide.mapInArrow(run, schema)
