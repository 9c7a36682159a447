"""The query registry and the inputs queries share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(col: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rd(expr: str, digits: int = 6) -> str:
    """The same rounding as SQL text."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def unit_hash_sql(key: str, seed: int = 42) -> str:
    return (
        f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"
        " / 4294967296.0)"
    )


# The tables hold no nulls, so null handling is tested on columns blanked by key.
# These expressions read the same in both engines.
ORDERS_GAPS = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate
    FROM orders"""

LINES_GAPS = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
           l_extendedprice,
           l_extendedprice * (1 - l_discount) AS net_price,
           CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_tax END AS l_tax,
           CAST(7.0 AS DOUBLE) AS flat
    FROM lineitem"""

CUSTOMER_GAPS = """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal
    FROM customer"""

DOC_FEATURES = """
    SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
           CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS n_words,
           CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
           CAST(len(regexp_extract_all(text, '[0-9]')) AS DOUBLE) AS n_digits
    FROM documents"""


def view_query(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """An input from the shared SQL text, over the named tables; leaves no view behind."""
    text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(tables)})\b", r"\1 {\2}", sql)
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in tables})


def orders_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(spark, sf_dir, ORDERS_GAPS, "orders")


def lines_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(spark, sf_dir, LINES_GAPS, "lineitem")


def customer_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_query(spark, sf_dir, CUSTOMER_GAPS, "customer")


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = DOC_FEATURES.replace("len(regexp_extract_all(text, '[0-9]'))", "regexp_count(text, '[0-9]')")
    return view_query(spark, sf_dir, sql, "documents")
