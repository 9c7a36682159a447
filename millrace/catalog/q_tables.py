"""Sources, sinks, profiles and column selection."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import CUSTOMER_GAPS, ORDERS_GAPS, customer_gaps, orders_gaps, query, table
from millrace.functions.columns import (
    drop_constant_columns,
    drop_duplicate_columns,
    drop_if_present,
    drop_null_rows,
    numeric_columns,
    prefix_columns,
    ref,
)
from millrace.session import scratch_path
from millrace.sources.files import list_labeled_files
from millrace.sources.listing import list_files
from millrace.sources.tables import preview, profile_change, read_table, write_table


@query(
    "csv_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
)
def csv_roundtrip(spark, d):
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "orders-csv")
    write_table(orders, path, "csv")
    back = read_table(spark, f"{path}/part-*.csv", "csv", orders.schema)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "csv_inferred",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation",
)
def csv_inferred(spark, d):
    path = scratch_path(spark, "nation-csv")
    write_table(table(spark, d, "nation"), path, "csv")
    return read_table(spark, path)


@query(
    "table_profile",
    f"""WITH g AS ({ORDERS_GAPS})
        SELECT 'before' AS version, count(*) AS n_rows, 6 AS n_columns FROM g
        UNION ALL
        SELECT 'after', count(*), 6 FROM g WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL""",
)
def table_profile(spark, d):
    gaps = orders_gaps(spark, d)
    return profile_change(gaps, drop_null_rows(gaps, ["o_totalprice", "o_orderdate"]))


@query(
    "preview_rows",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20""",
)
def preview_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return preview(orders, 20, ["o_orderkey"])


@query("numeric_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def numeric_projection(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(*[ref(c) for c in numeric_columns(orders)])


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


# Every table's files by their names and lengths, no content, beside the rows that Spark reads from them.
@query(
    "file_inventory",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n, true AS complete FROM {t}" for t in TABLES),
)
def file_inventory(spark, d):
    of = lambda path: F.regexp_extract(path, r"/([a-z]+)\.parquet(?:/[^/]*)?$", 1)
    files = list_files(spark, d, "*.parquet").groupBy(of(F.col("path")).alias("name"))
    listed = files.agg(F.count_if(F.col("length") > 0).alias("files"))
    read = [
        table(spark, d, t).groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("n")) for t in TABLES
    ]
    rows = reduce(DataFrame.unionByName, read).groupBy(of(F.col("path")).alias("name"))
    counted = rows.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("read"))
    return listed.join(counted, "name").select("name", "n", (F.col("files") == F.col("read")).alias("complete"))


@query("labeled_files", f"SELECT unnest({TABLES}) AS name, true AS in_folder")
def labeled_files(spark, d):
    """The files of one folder, which is their label."""
    root, folder = d.rstrip("/").rsplit("/", 1)
    found = list_labeled_files(spark, root, [folder], [".parquet"])
    name = F.regexp_extract("path", r"/([a-z]+)\.parquet$", 1)
    return found.select(name.alias("name"), (F.col("label_str") == folder).alias("in_folder"))


@query(
    "prefix_columns",
    """SELECT c_custkey, c_name AS cu_c_name, c_nationkey AS cu_c_nationkey FROM customer""",
)
def prefixed(spark, d):
    kept = drop_if_present(table(spark, d, "customer"), ["c_acctbal", "c_mktsegment", "not_there"])
    return prefix_columns(kept, "cu_", keep=["c_custkey"])


@query(
    "drop_duplicate_columns",
    "SELECT c_custkey, c_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def unique_names(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_regionkey")
    return drop_duplicate_columns(customer.join(nation, customer["nationkey"] == nation["nationkey"]))


@query(
    "drop_constant_columns",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              CASE WHEN o_orderkey % 2 = 0 THEN CAST(1.0 AS DOUBLE) END AS gappy FROM orders""",
)
def varying_columns(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.lit(5).alias("flat"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("o_orderkey") % 2 == 0, 1.0).alias("gappy"),
    )
    return drop_constant_columns(orders)


@query(
    "drop_null_rows",
    f"SELECT * FROM ({CUSTOMER_GAPS}) WHERE c_acctbal IS NOT NULL",
)
def complete_rows(spark, d):
    return drop_null_rows(customer_gaps(spark, d), ["c_acctbal"])
