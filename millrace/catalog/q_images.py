"""Path labels and pixel tables. Embeddings stand in for pictures of 8 x 8 pixels."""

from pyspark.sql import functions as F

from millrace.catalog.registry import query, rd, rounded, table
from millrace.functions.scalars import normalize_path, path_label, reshape_pixels, scale_pixels
from millrace.operators.images import decode_images, pixels_to_array, split_bad_records, to_training_table
from millrace.sources.files import filter_classes

CLASSES = ["en", "de", "fr"]


@query(
    "path_label",
    """SELECT page_id, regexp_replace(u, '^file:', '') AS path,
              CASE WHEN lower(url) LIKE '%/en/%' THEN 0 WHEN lower(url) LIKE '%/de/%' THEN 1
                   WHEN lower(url) LIKE '%/fr/%' THEN 2 ELSE -1 END AS by_folder,
              CASE WHEN contains(lower(url), 'en') THEN 0 ELSE 1 END AS by_text
       FROM (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN 'file:' || url ELSE url END AS u FROM pages)""",
)
def labelled_paths(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    with_scheme = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("file:"), "url")).otherwise(F.col("url"))
    return pages.select(
        "page_id",
        normalize_path(with_scheme).alias("path"),
        path_label(F.col("url"), CLASSES).alias("by_folder"),
        path_label(F.col("url"), CLASSES, "substring").alias("by_text"),
    )


@query(
    "filter_classes",
    """SELECT page_id, CASE WHEN lower(url) LIKE '%/en/%' THEN 0 WHEN lower(url) LIKE '%/de/%' THEN 1 ELSE 2 END AS label
       FROM pages WHERE lower(url) LIKE '%/en/%' OR lower(url) LIKE '%/de/%' OR lower(url) LIKE '%/fr/%'""",
)
def chosen_classes(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("path"))
    return filter_classes(pages, CLASSES).select("page_id", "label")


_WIDE = ", ".join(f"embedding[{i}] AS pixel{i}" for i in range(1, 65))


def wide_pixels(spark, d):
    vectors = table(spark, d, "embeddings")
    return vectors.select(
        "vec_id", "label", *[F.get("embedding", F.lit(i - 1)).alias(f"pixel{i}") for i in range(1, 65)]
    )


@query(
    "pixels_to_array",
    f"""SELECT label, count(*) AS n, {rd('sum(list_sum(CAST(embedding AS DOUBLE[])))')} AS total,
               {rd('sum(CAST(embedding[64] AS DOUBLE))')} AS last FROM embeddings GROUP BY label""",
)
def pixel_arrays(spark, d):
    rows = to_training_table(pixels_to_array(wide_pixels(spark, d), "pixel", 64), "features", "label")
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.sum(total)).alias("total"),
        rounded(F.sum(F.get("features", F.lit(63)))).alias("last"),
    )


@query(
    "scale_pixels",
    f"""SELECT vec_id, i, {rd('x / 255.0', 9)} AS x FROM (
            SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x,
                   CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS i FROM embeddings)""",
)
def scaled_pixels(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", scale_pixels(F.col("embedding")).alias("p"))
    return rows.select("vec_id", F.posexplode("p").alias("i", "x")).withColumn("x", rounded("x", 9))


@query(
    "reshape_pixels",
    f"""SELECT vec_id, CAST(i // 8 AS INT) AS r, CAST(i % 8 AS INT) AS c, {rd('x', 9)} AS x FROM (
            SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) - 1 AS i
            FROM embeddings)""",
)
def reshaped(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", reshape_pixels(F.col("embedding"), 8, 8).alias("m"))
    lines = rows.select("vec_id", F.posexplode("m").alias("r", "line"))
    return lines.select("vec_id", "r", F.posexplode("line").alias("c", "x")).withColumn("x", rounded("x", 9))


# One grey byte per value; every 17th record loses its last bytes, as a broken file would.
_BYTE = "CAST(least(255, greatest(0, floor(128 + CAST(x AS DOUBLE) * 300))) AS INT)"


def rasters(spark, d):
    vectors = table(spark, d, "embeddings")
    byte = F.transform(
        "embedding",
        lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(128 + x.cast("double") * 300)))), 2, "0"),
    )
    whole = F.unhex(F.array_join(byte, ""))
    cut = F.when(F.col("vec_id") % 17 == 0, F.unhex(F.array_join(F.slice(byte, 1, 40), ""))).otherwise(whole)
    side = F.lit(8)
    return vectors.select(
        "vec_id",
        F.concat(F.lit("vec/"), F.col("vec_id").cast("string")).alias("origin"),
        side.alias("height"),
        side.alias("width"),
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        cut.alias("data"),
    )


@query(
    "bad_records",
    """SELECT vec_id, 'vec/' || CAST(vec_id AS VARCHAR) AS origin, vec_id % 17 <> 0 AS readable FROM embeddings""",
)
def unreadable(spark, d):
    good, bad = split_bad_records(rasters(spark, d))
    return (
        good.withColumn("readable", F.lit(True))
        .unionByName(bad.withColumn("readable", F.lit(False)))
        .select("vec_id", "origin", "readable")
    )


# Halving a picture between pixel centres is the mean of each 2 x 2 block.
@query(
    "decode_images",
    f"""SELECT vec_id, CAST((i // 16) * 4 + (i % 8) // 2 AS INT) AS i, {rd('avg(b) / 255')} AS x
        FROM (SELECT vec_id, {_BYTE} AS b, i FROM (
                SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i
                FROM embeddings WHERE vec_id % 17 <> 0))
        GROUP BY 1, 2""",
)
def decoded(spark, d):
    rows = decode_images(rasters(spark, d), 4, channels=1)
    return rows.select("vec_id", F.posexplode("pixels").alias("i", "x")).withColumn("x", rounded("x"))
