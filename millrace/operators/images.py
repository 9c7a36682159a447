"""Picture and pixel tables: reading, resizing, scaling, splitting off unreadable records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.sources.files import empty_files

# Picture side and channels of the two loaders, weights of red, green, blue in grey.
GREY_SIDE = 48
COLOUR_SIDE = 128
GREY_WEIGHTS = (0.299, 0.587, 0.114)

#: Bytes of pixels that are worked on at a time.
PIXEL_BYTES = 16 << 20

IMAGE_FIELDS = ("origin", "height", "width", "nChannels", "mode", "data")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Pictures below ``path``, decoded by Spark's image source.

    Unreadable files, empty ones too, stay in the table with height -1. Bytes are rows of
    pixels, colours in the order blue, green, red.
    """
    images = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    found = images.select(*[F.col(f"image.{f}").alias(f) for f in IMAGE_FIELDS])
    shape = [F.lit(-1).alias(f) for f in IMAGE_FIELDS[1:5]]
    nothing = empty_files(spark, path).select(F.col("path").alias("origin"), *shape, F.lit(bytearray()).alias("data"))
    return found.unionByName(nothing)


def is_readable(df: DataFrame) -> Column:
    """Whether a record holds as many bytes as its shape says."""
    size = F.col("height") * F.col("width") * F.col("nChannels")
    return F.coalesce((F.col("height") > 0) & (F.octet_length("data") == size), F.lit(False))


def split_bad_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable and unreadable records."""
    good = is_readable(df)
    return df.filter(good), df.filter(~good)


def kernel(n_in: int, n_out: int, method: str) -> np.ndarray:
    """Weights that turn ``n_in`` samples to ``n_out``."""
    ratio = n_in / n_out
    wide = max(ratio, 1.0) if method == "bicubic" else 1.0
    centers = (np.arange(n_out) + 0.5) * ratio - 0.5
    if method == "bilinear":
        centers = np.clip(centers, 0, n_in - 1)
    gap = np.abs(np.arange(n_in)[None, :] - centers[:, None]) / wide
    if method == "bilinear":
        weights = np.maximum(1 - gap, 0)
    else:
        near = 1.5 * gap**3 - 2.5 * gap**2 + 1
        far = -0.5 * gap**3 + 2.5 * gap**2 - 4 * gap + 2
        weights = np.where(gap < 1, near, np.where(gap < 2, far, 0.0))
    return weights / weights.sum(axis=1, keepdims=True)


def resized(x: np.ndarray, height: int, width: int, method: str, weights: dict) -> np.ndarray:
    """Pictures ``[picture, row, column, channel]`` of one shape at another size."""
    for axis, n_out in ((2, width), (1, height)):
        n_in = x.shape[axis]
        if n_in != n_out:
            if (n_in, n_out) not in weights:
                weights[n_in, n_out] = kernel(n_in, n_out, method)
            x = np.moveaxis(np.tensordot(weights[n_in, n_out], x, (1, axis)), 0, axis)
            if method == "bicubic":
                x = np.clip(np.floor(x + 0.5), 0, 255)
    return x


def decode_images(
    df: DataFrame, side: int | tuple[int, int], channels: int = 1, method: str = "bilinear", kind: str = "double"
) -> DataFrame:
    """Readable records as ``pixels``: rows of an even size, scaled to 0..1, as ``kind``.

    ``bilinear`` samples between pixel centres; ``bicubic`` widens its kernel
    when shrinking and rounds to whole values, once per direction. Pictures of one shape are
    resized together, at most ``PIXEL_BYTES`` of results or of decoded input at a time, so
    memory grows with neither the size of the results nor the rows of a batch.
    """
    good, _ = split_bad_records(df)
    height, width = (side, side) if isinstance(side, int) else side
    passed = [f for f in good.schema.fields if f.name not in IMAGE_FIELDS]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed)
    out_size = height * width * channels
    number = np.dtype("float32" if kind == "float" else "float64")

    def tensor(data, h, w, c):
        x = np.frombuffer(b"".join(data), "uint8").reshape(len(data), h, w, c).astype("float64")
        if c >= 3:
            x = x[..., 2::-1]
        if channels == 1 and x.shape[3] > 1:
            x = np.floor(x @ np.array(GREY_WEIGHTS) + 0.5)[..., None]
        if channels == 3 and x.shape[3] == 1:
            x = np.repeat(x, 3, axis=3)
        return x

    def decode(batches):
        weights: dict = {}
        for batch in batches:
            n = batch.num_columns
            shapes = np.stack([batch.column(n - 4 + i).to_numpy() for i in range(3)], 1).astype(np.int64)
            data = batch.column(n - 1)
            # Decoded, a picture takes eight bytes for each of its own.
            cost = np.maximum(out_size, shapes.prod(1)) * 8
            at = 0
            while at < batch.num_rows:
                upto = at + max(1, int(np.searchsorted(np.cumsum(cost[at:]), PIXEL_BYTES, side="right")))
                pixels = np.empty((upto - at, out_size), number)
                same, first = np.unique(shapes[at:upto], axis=0, return_inverse=True)
                for i, (h, w, c) in enumerate(same.tolist()):
                    of = np.flatnonzero(first.ravel() == i)
                    x = tensor([data[at + j].as_py() for j in of.tolist()], h, w, c)
                    pixels[of] = (resized(x, height, width, method, weights) / 255.0).reshape(len(of), -1)
                ends = pa.array(np.arange(0, (upto - at + 1) * out_size, out_size, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(pixels.ravel()))
                part = batch.slice(at, upto - at)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: n - 4], lists], [*part.schema.names[: n - 4], "pixels"]
                )
                at = upto

    schema = (kept + ", " if kept else "") + f"pixels array<{kind}>"
    narrow = good.select(*[ref(f.name) for f in passed], "height", "width", "nChannels", "data")
    return narrow.mapInArrow(decode, schema)


def pixels_to_array(df: DataFrame, prefix: str = "pixel", n: int = 784, label: str = "label") -> DataFrame:
    """``(features, label)`` from the columns ``prefix1`` to ``prefixN``."""
    return df.select(
        F.array(*[ref(f"{prefix}{i}").cast("double") for i in range(1, n + 1)]).alias("features"),
        ref(label),
    )


def to_training_table(df: DataFrame, features: str, label: str) -> DataFrame:
    """``(features, label)`` rows, ready to be written as shards for a trainer."""
    return df.select(ref(features).alias("features"), ref(label).cast("int").alias("label"))
