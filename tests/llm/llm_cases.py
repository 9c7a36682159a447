"""Small tables with every awkward kind of row, shared by the tests."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("__row", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("stats", T.IntegerType()),
        T.StructField("__stats", T.IntegerType()),
    ]
)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


LONG = prose(5, 30_000, 5_000)

ROWS = [
    (1, "Alpha beta gamma delta."),
    (1, "Alpha beta gamma delta."),
    (7, "Alpha  beta\tgamma\ndelta."),
    (None, "Alpha beta gamma delta."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "\n\t "),
    (None, None),
    (6, "Größe naïve \U0001f600 é \x1c\x85　end"),
    (8, LONG),
    (9, LONG + " tail"),
    (10, "aaaaaaaaaa" * 60),
    (11, "!!! ??? ..."),
]


def stored(spark, folder, rows, schema=SCHEMA, name="docs"):
    """Rows padded to the schema, written as a table of several files and read back."""
    width = len(schema.fields)
    full = [tuple(r) + tuple("x" if f.dataType == T.StringType() else 1 for f in schema.fields[len(r) : width]) for r in rows]
    path = str(folder / name)
    spark.createDataFrame(full, schema).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def edge(spark, folder):
    return stored(spark, folder, ROWS)


def empty(spark, folder):
    return stored(spark, folder, [], name="empty")
