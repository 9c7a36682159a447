"""Keys that hold many rows, found without a shuffle of keys.

Every task keeps a summary of its keys (a Misra-Gries table of bounded size, Spark's
``approx_top_k`` functions); summaries add up, first in a few groups of tasks, then all
together. A summary of ``size`` keys is wrong by at most ``3.5 / size`` of all rows, so every
key beyond twice that is in it. Only the keys it names are then counted exactly.

Texts are summarised by their 64-bit hash, so that a summary has the same bounded size however
long they are; the texts behind the hashes that it names are looked up before they are counted.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import broadcast_small, materialize

#: Keys that a summary tracks at first and at most (Spark allows a million).
FIRST_SIZE, LARGEST_SIZE = 1 << 16, 1_000_000
#: Share of all rows by which a count in a summary of one key may be wrong, as published.
ERROR = 3.5
#: Groups of tasks whose summaries are added up before the last step.
GROUPS = 64
#: Summaries that the last step adds up.
LAST_GROUPS = 8
BROADCAST_ROWS = 10_000
# Types of keys that a summary takes.
SUMMARISED = ("string", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean", "float", "double")


def _item(df: DataFrame, key: str) -> Column:
    """What a summary keeps of a key: a text's hash, other keys as they are."""
    k = ref(key)
    return F.when(k.isNotNull(), F.xxhash64(k)) if _long(df, key) else k


def _long(df: DataFrame, key: str) -> bool:
    return df.schema[key].dataType.simpleString() == "string"


def summary(df: DataFrame, key: str, size: int) -> DataFrame:
    """One row: ``rows``, ``nulls`` and ``top``, an array of ``(item, count)``; the item of a
    text is its hash."""
    k = _item(df, key)
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS))
    parts = df.select(group.alias("__g"), k.alias("__k")).groupBy("__g").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__k").isNull()).alias("nulls"),
        F.expr(f"approx_top_k_accumulate(__k, {size})").alias("state"),
    )
    combined = [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.expr(f"approx_top_k_combine(state, {size})").alias("state"),
    ]
    # Without groups a state is also made of a part without rows, which Spark cannot store; so
    # groups are added up by groups, and the last ones in one part.
    few = parts.withColumn("__g", F.pmod("__g", F.lit(LAST_GROUPS))).groupBy("__g").agg(*combined)
    whole = few.repartition(1).agg(*combined)
    return whole.select("rows", "nulls", F.expr(f"approx_top_k_estimate(state, {size})").alias("top"))


def _counted(df: DataFrame, key: str, found: DataFrame | None) -> DataFrame:
    """``(key, n)`` exactly: of the keys found, or of all."""
    k = ref(key).alias(key)
    rows = df.select(k).filter(k.isNotNull())
    if found is not None:
        rows = rows.join(broadcast_small(found, BROADCAST_ROWS), key, "left_semi")
    return rows.groupBy(k).agg(F.count(F.lit(1)).alias("n"))


def candidates(
    df: DataFrame, key: str, more_than: int, wanted: int | None = None
) -> tuple[DataFrame | None, int]:
    """``(key)`` of all keys that may have over ``more_than`` rows, and the number of null keys.

    No key with more rows is missing; null is not among them. None instead of a table when
    no summary of the largest size can tell, or the type of the key allows none: then every
    key may be one. An empty table has no candidates. Keys with over ``wanted`` rows, a lower
    number, are also named, or as many of them as the largest summary can tell.
    """
    wanted = more_than if wanted is None else min(wanted, more_than)
    if df.schema[key].dataType.simpleString() not in SUMMARISED:
        return None, df.filter(ref(key).isNull()).count()
    if df.isEmpty():
        return df.select(ref(key).alias(key)), 0
    size = FIRST_SIZE
    while True:
        stored = materialize(summary(df, key, size), "key-summary")
        rows, nulls = stored.select("rows", "nulls").first()
        if 2 * ERROR * rows <= size * wanted:
            break
        if size >= LARGEST_SIZE:
            if 2 * ERROR * rows > size * more_than:
                return None, nulls
            wanted = 2 * ERROR * rows / size
            break
        size = min(LARGEST_SIZE, int(2 * ERROR * rows / wanted) + 1)
    # An estimate is never below the true count by more than the error.
    likely = stored.select(F.explode("top").alias("t")).filter(
        F.col("t.item").isNotNull() & (F.col("t.count") + ERROR * rows / size > wanted)
    )
    items = likely.select(F.col("t.item").alias(key))
    if not _long(df, key):
        return items, nulls
    if items.isEmpty():
        return df.select(ref(key).alias(key)).limit(0), nulls
    named = broadcast_small(items.select(F.col(key).alias("__item")), BROADCAST_ROWS)
    texts = df.select(ref(key).alias(key)).filter(ref(key).isNotNull())
    return texts.join(named, F.xxhash64(ref(key)) == F.col("__item"), "left_semi").distinct(), nulls


def frequent_keys(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """``(key, n)`` of all keys with over ``more_than`` rows, exactly; a null key is one of them."""
    found, nulls = candidates(df, key, more_than)
    counted = _counted(df, key, found).filter(F.col("n") > more_than)
    if nulls <= more_than:
        return counted
    kind = df.schema[key].dataType.simpleString()
    return counted.unionByName(df.sparkSession.createDataFrame([(None, nulls)], f"`{key}` {kind}, n bigint"))


def frequent_in_either(
    a: DataFrame, b: DataFrame, key: str, more_than: int, pairs: int | None = None
) -> DataFrame | None:
    """``(key, na, nb)`` of every key, null among them, with over ``more_than`` rows in one of
    the tables, with its exact number in both; None when there is no such key. With ``pairs``
    also keys, null excepted, whose rows make over that many pairs.

    The keys of both tables are read once, without a shuffle; only if the summaries name
    keys, these are looked up and counted in a second reading. Keys named for their pairs have
    over the root of ``pairs`` rows in one table; in tables so large that no summary tells keys
    of that size (rows over 140,000 times the root), only those are named that it can tell.
    """
    wanted = None if pairs is None else isqrt(pairs)
    (of_a, null_a), (of_b, null_b) = (candidates(df, key, more_than, wanted) for df in (a, b))
    found = None if of_a is None or of_b is None else materialize(of_a.union(of_b).distinct(), "likely-keys")
    spark, kind = a.sparkSession, a.schema[key].dataType.simpleString()
    nulls = spark.createDataFrame([(None, null_a, null_b)], f"`{key}` {kind}, na bigint, nb bigint")
    many = nulls.filter((F.col("na") > more_than) | (F.col("nb") > more_than))
    if found is not None and found.isEmpty():
        return many if max(null_a, null_b) > more_than else None
    counts = [_counted(df, key, found).withColumnRenamed("n", name) for df, name in ((a, "na"), (b, "nb"))]
    both = counts[0].join(counts[1], key, "full").na.fill(0, ["na", "nb"])
    is_hot = (F.col("na") > more_than) | (F.col("nb") > more_than)
    if pairs is not None:
        is_hot = is_hot | (F.col("na").cast("double") * F.col("nb") > pairs)
    hot = both.filter(is_hot).unionByName(many)
    hot = materialize(hot, "hot-keys")
    return None if hot.isEmpty() else hot
