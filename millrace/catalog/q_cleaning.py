"""Cleaning and distributions."""

from pyspark.sql import functions as F

from millrace.catalog.registry import (
    DOC_FEATURES,
    LINES_GAPS,
    ORDERS_GAPS,
    doc_features,
    lines_gaps,
    orders_gaps,
    query,
    rd,
    rounded,
    table,
    unit_hash_sql,
    view_query,
)
from millrace.functions.columns import ref
from millrace.functions.scalars import fill_date, parse_length_inches, strip_suffix
from millrace.operators.cleaning import (
    dedup_rows,
    fill_strings,
    impute_mean,
    missing_profile,
    missing_topk,
    sample_rows,
    zscore_filter,
)
from millrace.operators.distribution import histogram, kde, label_threshold
from millrace.session import materialize


@query("dedup_rows", "SELECT DISTINCT md5(text) AS text_md5, lang, source FROM documents")
def dedup(spark, d):
    rows = dedup_rows(table(spark, d, "documents").select("text", "lang", "source"))
    return rows.select(F.md5("text").alias("text_md5"), "lang", "source")


@query(
    "dedup_subset",
    """SELECT doc_id, lang, source FROM documents
       QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""",
)
def dedup_by(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return dedup_rows(docs, ["text", "lang"], order_by=["doc_id"]).select("doc_id", "lang", "source")


@query(
    "fill_strings",
    f"""SELECT o_orderkey, coalesce(o_orderstatus, 'Unknown') AS o_orderstatus,
               coalesce(o_orderpriority, 'Unknown') AS o_orderpriority FROM ({ORDERS_GAPS})""",
)
def filled(spark, d):
    return fill_strings(orders_gaps(spark, d)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


LENGTHS = """
    SELECT p_partkey,
           CASE p_partkey % 12
                WHEN 0 THEN CAST(p_size AS VARCHAR(9)) || '-' || CAST(p_partkey % 11 AS VARCHAR(9))
                WHEN 1 THEN CAST(150 + p_size AS VARCHAR(9))
                WHEN 2 THEN 'a-b'
                WHEN 3 THEN '6-7-8'
                WHEN 4 THEN ''
                WHEN 5 THEN NULL
                WHEN 6 THEN '-' || CAST(p_size AS VARCHAR(9))
                WHEN 7 THEN ' ' || CAST(100 + p_size AS VARCHAR(9)) || '.5 '
                WHEN 8 THEN CAST(p_size AS VARCHAR(9)) || '-'
                WHEN 9 THEN '1e' || CAST(p_size % 4 AS VARCHAR(9))
                WHEN 10 THEN 'nan'
                ELSE CAST(1.27 * (2 * p_size + 1) AS VARCHAR(9)) END AS height
    FROM part"""


@query(
    "parse_length",
    f"""SELECT p_partkey, CAST(CASE
            WHEN regexp_full_match(height, '[0-9]+-[0-9]+')
                THEN 12 * CAST(split_part(height, '-', 1) AS INT) + CAST(split_part(height, '-', 2) AS INT)
            WHEN len(string_split(height, '-')) > 2 THEN NULL
            WHEN trim(height) IN ('nan', 'inf') THEN NULL
            ELSE round_even(TRY_CAST(trim(height) AS DOUBLE) / 2.54, 0) END AS DOUBLE) AS height_in
        FROM ({LENGTHS})""",
)
def lengths(spark, d):
    part = view_query(spark, d, LENGTHS, "part")
    return part.select("p_partkey", parse_length_inches(ref("height")).cast("double").alias("height_in"))


@query(
    "impute_mean",
    f"""SELECT l_orderkey, l_linenumber,
               {rd("coalesce(l_quantity, (SELECT avg(l_quantity) FROM g))")} AS l_quantity,
               {rd("coalesce(l_tax, (SELECT avg(l_tax) FROM g))")} AS l_tax
        FROM (SELECT * FROM g) WHERE true""".replace(
        "SELECT l_orderkey", f"WITH g AS ({LINES_GAPS}) SELECT l_orderkey", 1
    ),
)
def imputed(spark, d):
    rows = impute_mean(lines_gaps(spark, d), ["l_quantity", "l_tax"])
    return rows.select(
        "l_orderkey", "l_linenumber", rounded("l_quantity").alias("l_quantity"), rounded("l_tax").alias("l_tax")
    )


@query(
    "fill_date",
    f"""SELECT o_orderkey, strftime(coalesce(o_orderdate, DATE '1900-01-01'), '%Y-%m-%d') AS o_orderdate
        FROM ({ORDERS_GAPS})""",
)
def dated(spark, d):
    return orders_gaps(spark, d).select(
        "o_orderkey", F.date_format(fill_date(F.col("o_orderdate")), "yyyy-MM-dd").alias("o_orderdate")
    )


@query(
    "strip_suffix",
    "SELECT o_orderkey, regexp_replace(o_orderpriority, '-.*', '') AS o_orderpriority FROM orders",
)
def stripped(spark, d):
    orders = table(spark, d, "orders")
    return orders.select("o_orderkey", strip_suffix(F.col("o_orderpriority")).alias("o_orderpriority"))


def _passes(source: str, cols: list[str], out: str) -> str:
    """Outlier passes as chained CTEs."""
    ctes, last = [f"r0 AS ({source})"], "r0"
    for i, c in enumerate(cols, 1):
        ctes.append(f"s{i} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {last})")
        ctes.append(f"r{i} AS (SELECT r.* FROM {last} r, s{i} WHERE abs(({c} - m) / s) <= 3)")
        last = f"r{i}"
    return f"WITH {', '.join(ctes)} SELECT {out} FROM {last}"


@query("zscore_filter", _passes("SELECT event_id, value FROM events", ["value"], "event_id, value"))
def zscore_events(spark, d):
    return zscore_filter(table(spark, d, "events").select("event_id", "value"), ["value"])


@query(
    "zscore_filter_chain",
    _passes(DOC_FEATURES, ["n_chars", "n_lines", "n_digits"], "doc_id, n_chars, n_lines, n_digits"),
)
def zscore_documents(spark, d):
    cols = ["n_chars", "n_lines", "n_digits"]
    # written down once, so that the passes do not count in the texts again
    rows = materialize(doc_features(spark, d).select("doc_id", *cols), "text-counts")
    return zscore_filter(rows, cols)


_GAP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"]
_MISSING = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count(*) - count({c}) AS missing FROM g"
    for i, c in enumerate(_GAP_COLUMNS)
)


@query("missing_profile", f"WITH g AS ({ORDERS_GAPS}) {_MISSING}")
def missing(spark, d):
    return missing_profile(orders_gaps(spark, d))


@query(
    "missing_topk",
    f"""WITH g AS ({ORDERS_GAPS}), m AS ({_MISSING})
        SELECT "column", missing FROM m ORDER BY missing DESC, position LIMIT 5""",
)
def missing_most(spark, d):
    return missing_topk(orders_gaps(spark, d), 5)


@query(
    "sample_rows",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE {unit_hash_sql('o_orderkey')} < 0.25",
)
def sampled(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sample_rows(orders, 0.25, key="o_orderkey")


def histogram_sql(source: str, col: str, bins: int) -> str:
    """Histogram rows of a column as SQL, with unrounded edges."""
    return f"""
        SELECT CAST(b AS INT) AS bin, lo + b * w AS lo, lo + (b + 1) * w AS hi, coalesce(n, 0) AS n
        FROM (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {source}),
             range({bins}) r(b)
        LEFT JOIN (SELECT CAST(least(floor(({col} - lo) / w), {bins - 1}) AS BIGINT) AS k, count(*) AS n
                   FROM {source},
                        (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {source})
                   GROUP BY 1) ON k = b"""


def _edges(rows):
    return rows.withColumns({"lo": rounded("lo"), "hi": rounded("hi")})


@query(
    "histogram",
    f"SELECT bin, {rd('lo')} AS lo, {rd('hi')} AS hi, n FROM ({histogram_sql('events', 'value', 30)})",
)
def histogram_events(spark, d):
    return _edges(histogram(table(spark, d, "events"), "value", 30))


@query(
    "kde_grid",
    f"""WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
                          stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
             g AS (SELECT b, lo + b * ((hi - lo) / 199) AS x, n, h FROM s, range(200) r(b))
        SELECT CAST(b AS INT) AS point, {rd('x')} AS x,
               {rd('sum(exp(-0.5 * pow((x - value) / h, 2))) / any_value(n * h * sqrt(2 * pi()))', 9)} AS density
        FROM g, events GROUP BY b, x""",
)
def density(spark, d):
    rows = kde(table(spark, d, "events"), "value", 200)
    return rows.select("point", rounded("x").alias("x"), rounded("density", 9).alias("density"))


@query(
    "label_threshold",
    f"""SELECT bin, {rd('lo')} AS lo, {rd('hi')} AS hi, n, {rd('m')} AS threshold,
               (lo <= m AND m < hi) AS holds_threshold
        FROM ({histogram_sql('documents', 'n_chars', 35)}), (SELECT avg(n_chars) AS m FROM documents)""",
)
def threshold(spark, d):
    rows = label_threshold(table(spark, d, "documents"), "n_chars", 35)
    return _edges(rows).withColumn("threshold", rounded("threshold"))
