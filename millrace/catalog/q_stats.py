"""Statistics, correlation and principal components."""

from functools import reduce
from itertools import combinations, combinations_with_replacement

from pyspark.sql import functions as F

from millrace.catalog.registry import LINES_GAPS, lines_gaps, query, rd, rounded, table
from millrace.functions.columns import drop_constant_columns
from millrace.operators.cleaning import impute_mean
from millrace.operators.distribution import box_summary, exact_quantiles
from millrace.operators.stats import (
    column_stats,
    correlation_matrix,
    covariance_matrix,
    group_sizes,
    pca_fit,
    pca_project,
    pca_variance,
    prune_correlated,
)

_STAT_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "net_price", "l_tax", "flat"]


@query(
    "column_stats",
    f"WITH g AS ({LINES_GAPS}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(DISTINCT {c}) AS n_distinct,
                   {rd(f'avg({c})', 4)} AS mean, {rd(f'stddev_samp({c})', 4)} AS stddev,
                   {rd(f'min({c})')} AS min, {rd(f'max({c})')} AS max FROM g"""
        for c in _STAT_COLS
    ),
)
def stats(spark, d):
    rows = column_stats(lines_gaps(spark, d), _STAT_COLS)
    return rows.select(
        "column", "n", "n_distinct", rounded("mean", 4).alias("mean"), rounded("stddev", 4).alias("stddev"),
        rounded("min").alias("min"), rounded("max").alias("max"),
    )


@query(
    "group_sizes",
    f"""SELECT event_type, count(*) AS n, {rd('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct
        FROM events GROUP BY event_type""",
)
def sizes(spark, d):
    return group_sizes(table(spark, d, "events"), "event_type").withColumn("pct", rounded("pct"))


def _box_sql(source: str, col: str, by: str) -> str:
    return f"""
        WITH q AS (SELECT {by}, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median,
                          quantile_cont({col}, 0.75) AS q3 FROM {source} GROUP BY {by}),
             j AS (SELECT s.{by}, {col} AS v, q1, median, q3,
                          {col} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                   FROM {source} s JOIN q ON s.{by} = q.{by})
        SELECT {by}, count(*) AS n, {rd('any_value(q1)')} AS q1, {rd('any_value(median)')} AS median,
               {rd('any_value(q3)')} AS q3, {rd('min(v) FILTER (inside)')} AS whisker_low,
               {rd('max(v) FILTER (inside)')} AS whisker_high, count(*) FILTER (NOT inside) AS outliers
        FROM j GROUP BY {by}"""


def _box(rows, by):
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return rows.select(by, "n", *[rounded(c).alias(c) for c in numbers], "outliers")


@query("box_summary", _box_sql("events", "value", "event_type"))
def box_events(spark, d):
    return _box(box_summary(table(spark, d, "events"), "value", "event_type"), "event_type")


@query("box_summary_segments", _box_sql("customer", "c_acctbal", "c_mktsegment"))
def box_customers(spark, d):
    return _box(box_summary(table(spark, d, "customer"), "c_acctbal", "c_mktsegment"), "c_mktsegment")


@query(
    "exact_quantiles",
    " UNION ALL ".join(
        f"SELECT l_returnflag, CAST({p} AS DOUBLE) AS share, {rd(f'quantile_cont(l_extendedprice, {p})')} AS value"
        " FROM lineitem GROUP BY l_returnflag"
        for p in (0.05, 0.5, 0.95)
    ),
)
def quantiles(spark, d):
    rows = exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", [0.05, 0.5, 0.95], ["l_returnflag"])
    return rows.select("l_returnflag", "share", rounded("value").alias("value"))


_CORR_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "net_price", "l_tax"]


@query(
    "correlation_matrix",
    f"WITH g AS ({LINES_GAPS}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_i, '{b}' AS col_j, {rd(f'abs(corr({a}, {b}))')} AS corr FROM g"
        for a, b in combinations(_CORR_COLS, 2)
    ),
)
def correlations(spark, d):
    rows = correlation_matrix(drop_constant_columns(lines_gaps(spark, d)), _CORR_COLS)
    return rows.withColumn("corr", rounded("corr"))


_DIMS = 64


@query(
    "correlation_matrix_wide",
    "WITH g AS (SELECT "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(_DIMS))
    + " FROM embeddings) "
    + " UNION ALL ".join(
        f"SELECT 'e{a}' AS col_i, 'e{b}' AS col_j, {rd(f'abs(corr(e{a}, e{b}))')} AS corr FROM g"
        for a, b in combinations(range(_DIMS), 2)
    ),
)
def correlations_wide(spark, d):
    vectors = table(spark, d, "embeddings")
    wide = vectors.select(*[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(_DIMS)])
    return correlation_matrix(wide).withColumn("corr", rounded("corr"))


@query(
    "prune_correlated",
    f"""SELECT l_orderkey, l_linenumber, {rd('l_quantity')} AS l_quantity,
               {rd('l_extendedprice')} AS l_extendedprice, {rd('l_tax')} AS l_tax
        FROM ({LINES_GAPS})""",
)
def pruned(spark, d):
    rows = prune_correlated(drop_constant_columns(lines_gaps(spark, d)))
    return rows.withColumns(
        {c: rounded(c) for c in rows.columns if c not in ("l_orderkey", "l_linenumber")}
    )


@query(
    "covariance_matrix",
    f"WITH g AS ({LINES_GAPS}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_i, '{b}' AS col_j, {rd(f'covar_samp({a}, {b})', 2)} AS cov FROM g"
        for a, b in combinations_with_replacement(_CORR_COLS, 2)
    ),
)
def covariances(spark, d):
    return covariance_matrix(lines_gaps(spark, d), _CORR_COLS).withColumn("cov", rounded("cov", 2))


def pca_rows(spark, d):
    """Line items with gaps filled, and the columns that go into the components."""
    rows = impute_mean(drop_constant_columns(lines_gaps(spark, d)), ["l_quantity", "l_tax"])
    return rows, ["l_linenumber", "l_quantity", "l_extendedprice", "l_tax"]


# The shares of variance sum to 1 and the first component carries nearly all of it,
# since prices are thousands of times larger than the other columns.
@query(
    "pca_variance",
    "SELECT unnest([1, 2, 3, 4]) AS component, true AS falling, true AS in_sum, true AS by_the_rule",
)
def variance(spark, d):
    rows, cols = pca_rows(spark, d)
    found = sorted(pca_variance(rows, pca_fit(rows, cols)).collect(), key=lambda r: r["component"])
    ratios = [r["ratio"] for r in found]
    checks = [
        (
            r["component"], i == 0 or ratios[i - 1] >= ratios[i],
            abs(r["cumulative"] - sum(ratios[: i + 1])) < 1e-9 and abs(sum(ratios) - 1) < 1e-9,
            r["kept"] == (sum(ratios[:i]) < 0.95),
        )
        for i, r in enumerate(found)
    ]
    return spark.createDataFrame(checks, "component int, falling boolean, in_sum boolean, by_the_rule boolean")


# Components turn a row without changing its length, and the other columns pass through.
_LENGTH = "l_linenumber * l_linenumber + l_quantity * l_quantity + l_extendedprice * l_extendedprice + l_tax * l_tax"


@query(
    "pca_project",
    f"""WITH g AS ({LINES_GAPS}), f AS (
            SELECT l_orderkey, l_linenumber, coalesce(l_quantity, (SELECT avg(l_quantity) FROM g)) AS l_quantity,
                   l_extendedprice, coalesce(l_tax, (SELECT avg(l_tax) FROM g)) AS l_tax FROM g)
        SELECT l_orderkey, {rd(f'sqrt({_LENGTH})', 4)} AS length FROM f""",
)
def projected(spark, d):
    rows, cols = pca_rows(spark, d)
    out = pca_project(rows.select("l_orderkey", *cols), cols, k=len(cols))
    square = reduce(lambda a, b: a + b, [F.col(f"PC{i + 1}") * F.col(f"PC{i + 1}") for i in range(len(cols))])
    return out.select("l_orderkey", rounded(F.sqrt(square), 4).alias("length"))


# k is 0.1 wherever a is present and 0.5 elsewhere: no correlation is defined, so nothing is dropped.
@query("prune_with_gaps", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS a, "
       "CASE WHEN o_orderkey % 3 > 0 THEN 0.1 ELSE 0.5 END AS k FROM orders")  # fmt: skip
def pruned_gaps(spark, d):
    present = F.col("o_orderkey") % 3 > 0
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.when(present, F.col("o_totalprice")).alias("a"), F.when(present, 0.1).otherwise(0.5).alias("k")
    )
    return prune_correlated(rows, ["a", "k"])


_PCA_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# Projecting on all components turns the rows without stretching them and leaves no correlation.
@query(
    "pca_invariants",
    f"""SELECT {rd(' + '.join(f'avg({c} * {c})' for c in _PCA_COLS), 2)} AS energy,
               {rd(' + '.join(f'var_samp({c})' for c in _PCA_COLS), 2)} AS variance,
               CAST(0.0 AS DOUBLE) AS left_over FROM lineitem""",
)
def invariants(spark, d):
    rows = table(spark, d, "lineitem").select(*_PCA_COLS)
    scores = pca_project(rows, _PCA_COLS, k=len(_PCA_COLS)).select(
        *[f"PC{i + 1}" for i in range(len(_PCA_COLS))]
    )
    left_over = correlation_matrix(scores).agg(F.max("corr")).scalar()
    energy = sum((F.avg(F.col(c) * F.col(c)) for c in scores.columns), F.lit(0.0))
    variance = sum((F.var_samp(c) for c in scores.columns), F.lit(0.0))
    return scores.agg(rounded(energy, 2).alias("energy"), rounded(variance, 2).alias("variance")).withColumn(
        "left_over", rounded(left_over, 6)
    )


# For two columns the eigenvalues have a closed form, and |PC1| follows from the angle.
@query(
    "pca_two_columns",
    f"""WITH m AS (SELECT var_samp(c_acctbal) AS a, var_samp(CAST(c_nationkey * 300 AS DOUBLE)) AS c,
                          covar_samp(c_acctbal, CAST(c_nationkey * 300 AS DOUBLE)) AS b FROM customer),
             e AS (SELECT (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1, a, b, c FROM m),
             v AS (SELECT b AS x, l1 - a AS y, sqrt(b * b + (l1 - a) * (l1 - a)) AS len, l1 / (a + c) AS share FROM e)
        SELECT c_custkey, {rd('abs((c_acctbal * x + c_nationkey * 300 * y) / len)', 4)} AS pc1,
               {rd('share')} AS share
        FROM customer, v""",
)
def two_columns(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", "c_acctbal", (F.col("c_nationkey") * 300).cast("double").alias("nation")
    )
    model = pca_fit(rows, ["c_acctbal", "nation"])
    share = float(model.explainedVariance[0])
    return pca_project(rows, ["c_acctbal", "nation"], model, 1).select(
        "c_custkey", rounded(F.abs("PC1"), 4).alias("pc1"), rounded(F.lit(share)).alias("share")
    )
