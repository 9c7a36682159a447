"""Running Python over whole texts in bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref

#: Text bytes handled at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20

#: A-Z lower-cased, every other ASCII character that is no letter or digit made a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(raw: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything outside ASCII, A-Z lower-cased."""
    return raw.translate(WORD_BYTES).split()


def slices(
    batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows of about ``limit`` text bytes, with their texts in UTF-8 (null: empty)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = column.slice(start, stop - start)
        raw = pc.fill_null(part.cast(pa.binary()), b"").to_pylist()
        yield batch.slice(start, stop - start), raw
        start = stop


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch | None]],
    schema,
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``make()``, called once a task, to slices of rows and their texts."""

    def run(batches):
        work = make()
        for batch in batches:
            for part, raw in slices(batch, text, limit):
                out = work(part, raw)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tagged(df: DataFrame, *columns: str, tag: str = "__row") -> DataFrame:
    """The given columns and a number that tells rows apart, repeated rows too.

    It is made of the part and place of the row, so ``df`` must be a stored table, which
    reads the same way each time.
    """
    return df.select(F.monotonically_increasing_id().alias(tag), *[ref(c) for c in columns])
