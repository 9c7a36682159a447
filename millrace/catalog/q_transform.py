"""Scaling, encoding, binning, clustering."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.catalog.q_cleaning import histogram_sql
from millrace.catalog.registry import LINES_GAPS, ORDERS_GAPS, lines_gaps, orders_gaps, query, rd, rounded, table
from millrace.operators.binning import equal_width_bins, quantile_bins
from millrace.operators.clustering import (
    assign_to,
    class_centroids,
    kmeans_centers,
    kmeans_elbow,
    nearest_centroid,
)
from millrace.operators.encoding import encode, string_index
from millrace.operators.labeling import label_from_bin
from millrace.operators.scaling import (
    assemble,
    explode_vector,
    minmax_scale,
    scale_all,
    scaling_histograms,
    standard_scale,
)
from millrace.operators.stats import group_sizes

_VEC = ["l_quantity", "l_extendedprice", "l_tax"]


@query(
    "assemble_policy",
    f"""WITH g AS ({LINES_GAPS})
        SELECT 'keep' AS policy, count(*) AS n, {rd('sum(l_extendedprice)', 2)} AS total,
               count(l_quantity) AS filled FROM g
        UNION ALL
        SELECT 'skip', count(*), {rd('sum(l_extendedprice)', 2)}, count(*) FROM g
        WHERE l_quantity IS NOT NULL AND l_tax IS NOT NULL""",
)
def policies(spark, d):
    rows = lines_gaps(spark, d).select(*_VEC)

    def summed(policy):
        flat = explode_vector(assemble(rows, _VEC, "v", policy).select("v"), "v", ["q", "p", "t"])
        return flat.agg(
            F.lit(policy).alias("policy"),
            F.count(F.lit(1)).alias("n"),
            rounded(F.sum("p"), 2).alias("total"),
            F.count_if(~F.isnan("q")).alias("filled"),
        )

    return summed("keep").unionByName(summed("skip"))


_SCALED = ["l_quantity", "l_extendedprice", "flat"]


@query(
    "minmax_scale",
    f"""WITH g AS ({LINES_GAPS}),
             s AS (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh,
                          min(l_extendedprice) AS pl, max(l_extendedprice) AS ph FROM g)
        SELECT l_orderkey, l_linenumber, {rd('(l_quantity - ql) / (qh - ql)')} AS l_quantity_minmax,
               {rd('(l_extendedprice - pl) / (ph - pl)')} AS l_extendedprice_minmax, CAST(0.5 AS DOUBLE) AS flat_minmax
        FROM g, s""",
)
def minmax(spark, d):
    rows = minmax_scale(lines_gaps(spark, d), _SCALED)
    return rows.select("l_orderkey", "l_linenumber", *[rounded(f"{c}_minmax").alias(f"{c}_minmax") for c in _SCALED])


@query(
    "standard_scale",
    f"""WITH g AS ({LINES_GAPS}),
             s AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs,
                          avg(l_extendedprice) AS pm, stddev_samp(l_extendedprice) AS ps FROM g)
        SELECT l_orderkey, l_linenumber, {rd('(l_quantity - qm) / qs')} AS l_quantity_standard,
               {rd('(l_extendedprice - pm) / ps')} AS l_extendedprice_standard, CAST(0.0 AS DOUBLE) AS flat_standard
        FROM g, s""",
)
def standard(spark, d):
    rows = standard_scale(lines_gaps(spark, d), _SCALED)
    return rows.select(
        "l_orderkey", "l_linenumber", *[rounded(f"{c}_standard").alias(f"{c}_standard") for c in _SCALED]
    )


def _scaled_sql() -> str:
    return """SELECT l_quantity, (l_quantity - lo) / (hi - lo) AS l_quantity_minmax,
                     (l_quantity - m) / s AS l_quantity_standard
              FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, avg(l_quantity) AS m,
                                     stddev_samp(l_quantity) AS s FROM lineitem)"""


# Few distinct quantities, so the bins are chosen to keep values off the bin edges.
@query(
    "scaling_histograms",
    f"WITH h AS ({_scaled_sql()}) "
    + " UNION ALL ".join(
        f"SELECT bin, {rd('lo')} AS lo, {rd('hi')} AS hi, n, '{version}' AS version FROM ({histogram_sql('h', col, 30)})"
        for version, col in (
            ("original", "l_quantity"),
            ("minmax", "l_quantity_minmax"),
            ("standard", "l_quantity_standard"),
        )
    ),
)
def scaling_compared(spark, d):
    scaled = scale_all(table(spark, d, "lineitem").select("l_quantity"), ["l_quantity"])
    return scaling_histograms(scaled, "l_quantity", 30).withColumns({"lo": rounded("lo"), "hi": rounded("hi")})


def _rank_sql(source: str, col: str) -> str:
    return f"""(SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS i
                FROM {source} WHERE {col} IS NOT NULL GROUP BY {col})"""


@query(
    "string_index",
    f"""WITH g AS ({ORDERS_GAPS}), p AS {_rank_sql('g', 'o_orderpriority')}, s AS {_rank_sql('g', 'o_orderstatus')}
        SELECT o_orderkey, coalesce(p.i, (SELECT count(*) FROM p)) AS o_orderpriority_index,
               coalesce(s.i, (SELECT count(*) FROM s)) AS o_orderstatus_index
        FROM g LEFT JOIN p USING (o_orderpriority) LEFT JOIN s USING (o_orderstatus)""",
)
def indexed(spark, d):
    rows = string_index(orders_gaps(spark, d), ["o_orderpriority", "o_orderstatus"])
    return rows.select("o_orderkey", "o_orderpriority_index", "o_orderstatus_index")


@query(
    "string_index_many_labels",
    f"""WITH p AS {_rank_sql('documents', 'text')}
        SELECT doc_id, i AS text_index FROM documents JOIN p USING (text)""",
)
def indexed_many(spark, d):
    """Ranks nearly as many labels as rows, by the distributed sort."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return string_index(docs, ["text"], invalid="error", short_list=100).select("doc_id", "text_index")


@query(
    "one_hot",
    f"""WITH g AS ({ORDERS_GAPS}), p AS {_rank_sql('g', 'o_orderpriority')}
        SELECT o_orderkey, list_aggregate(list_transform(range((SELECT count(*) FROM p)),
                   lambda x: CASE WHEN x = i THEN '1' ELSE '0' END), 'string_agg', '') AS priority
        FROM g LEFT JOIN p USING (o_orderpriority)""",
)
def encoded(spark, d):
    rows = encode(orders_gaps(spark, d), ["o_orderpriority"], sparse=False)
    bits = F.transform("o_orderpriority_index_onehot", lambda x: x.cast("int").cast("string"))
    return rows.select("o_orderkey", F.array_join(bits, "").alias("priority"))


def _width_sql(source: str, col: str, key: str) -> str:
    return f"""SELECT {key}, least(floor(({col} - lo) / ((hi - lo) / 5)), 4) + 0.0 AS {col}_equal_width
               FROM {source}, (SELECT min({col}) AS lo, max({col}) AS hi FROM {source})"""


@query("equal_width_bins", _width_sql("events", "value", "event_id"))
def widths(spark, d):
    rows = equal_width_bins(table(spark, d, "events").select("event_id", "value"), ["value"])
    return rows.select("event_id", "value_equal_width")


def _quantile_bin_sql(source: str, col: str) -> str:
    steps = " + ".join(f"CASE WHEN {col} >= q[{i}] THEN 1.0 ELSE 0.0 END" for i in range(1, 5))
    return f"""CAST(CASE WHEN {col} IS NOT NULL THEN {steps} END AS DOUBLE)
               FROM {source}, (SELECT quantile_disc({col}, [0.2, 0.4, 0.6, 0.8]) AS q FROM {source})"""


@query("quantile_bins", f"SELECT event_id, {_quantile_bin_sql('events', 'value').replace('FROM', 'AS value_quantile FROM', 1)}")
def quantile_binned(spark, d):
    rows = quantile_bins(table(spark, d, "events").select("event_id", "value"), ["value"])
    return rows.select("event_id", "value_quantile")


@query(
    "label_from_bin",
    f"""SELECT c_custkey, CAST(b AS INT) AS label FROM (
            SELECT c_custkey, {_quantile_bin_sql('customer', 'c_acctbal').replace('FROM', 'AS b FROM', 1)})""",
)
def binned_label(spark, d):
    rows = quantile_bins(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return label_from_bin(rows, "c_acctbal_quantile").select("c_custkey", "label")


# Mean vector per class, then the nearest one by squared distance.
NEAREST = """
    e AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i
          FROM embeddings),
    c AS (SELECT label AS k, i, avg(x) AS m FROM e GROUP BY label, i),
    dist AS (SELECT vec_id, e.label, k, sum((x - m) * (x - m)) AS d FROM e JOIN c USING (i) GROUP BY vec_id, e.label, k),
    nearest AS (SELECT vec_id, any_value(label) AS label, CAST(arg_min(k, d) AS INT) AS cluster
                FROM dist GROUP BY vec_id)"""


@query("nearest_centroid", f"WITH {NEAREST} SELECT vec_id, label, cluster FROM nearest")
def nearest(spark, d):
    vectors = table(spark, d, "embeddings")
    centers = class_centroids(vectors, "label", "embedding")
    return nearest_centroid(vectors, centers, "embedding").select("vec_id", "label", "cluster")


_CLUSTER_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def squares(cols, center):
    """Squared distance of a row to a centre, written out."""
    away = [F.col(c) - F.lit(float(v)) for c, v in zip(cols, center)]
    return reduce(lambda x, y: x + y, [a * a for a in away])


def means_by_hand(rows, cols, centers):
    """For centres given by a fit: the cost, and the rows and mean of what is next to each, from
    distances compared one by one."""
    far = F.array(*[squares(cols, c) for c in centers])
    least = F.array_min(far)
    near = rows.select(least.alias("d"), (F.array_position(far, least) - 1).cast("int").alias("i"), *cols)
    found = near.groupBy("i").agg(F.sum("d").alias("d"), F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])
    return {r["i"]: r for r in found.collect()}


@query("kmeans_elbow", "SELECT unnest([3, 4, 5, 6, 7]) AS k, true AS falls, true AS cost_holds")
def elbow(spark, d):
    """The costs fall, and are those that follow from the returned centres."""
    rows = table(spark, d, "lineitem").select(*_CLUSTER_COLS)
    out, last = [], float("inf")
    for k, cost, centers in sorted(map(tuple, kmeans_elbow(rows, _CLUSTER_COLS).collect())):
        again = sum(r["d"] for r in means_by_hand(rows, _CLUSTER_COLS, centers).values())
        out.append((k, 0 < cost < last, abs(again - cost) <= 1e-9 * cost))
        last = cost
    return spark.createDataFrame(out, "k int, falls boolean, cost_holds boolean")


@query(
    "kmeans_assign",
    f"SELECT count(*) AS n, CAST(4 AS BIGINT) AS clusters, {rd('100.0')} AS pct, CAST(0 AS BIGINT) AS misplaced, "
    "true AS centers_are_means FROM lineitem",
)
def clusters(spark, d):
    """Every row is next to its centre, and every centre is the mean of its rows, but for the last move."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_CLUSTER_COLS)
    centers = kmeans_centers(rows, _CLUSTER_COLS, max_iter=200)
    assigned = assign_to(rows, _CLUSTER_COLS, centers)
    sizes = group_sizes(assigned, "cluster")
    far = F.array(*[squares(_CLUSTER_COLS, c) for c in centers])
    # The number is an expression over the centres: named once, it is worked out once for each row.
    misplaced = assigned.filter(F.get(far, F.col("cluster")) > F.array_min(far) * (1 + 1e-12)).count()
    by_hand = means_by_hand(rows, _CLUSTER_COLS, centers)
    settled = all(abs(by_hand[i][c] - v) <= 1e-3 for i, center in enumerate(centers) for c, v in zip(_CLUSTER_COLS, center))
    return sizes.agg(
        F.sum("n").alias("n"), F.count("cluster").alias("clusters"), rounded(F.sum("pct")).alias("pct"),
        F.lit(misplaced).cast("bigint").alias("misplaced"), F.lit(settled).alias("centers_are_means"),
    )


@query("cluster_scatter", "SELECT o_orderkey, o_totalprice, o_custkey, true AS nearest FROM orders")
def scatter(spark, d):
    """Two features of all rows, and whether the cluster is that of the nearest centre."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cols = ["o_totalprice", "o_custkey"]
    centers = kmeans_centers(orders, cols)
    far = F.array(*[squares(cols, c) for c in centers])
    nearest = F.get(far, F.col("cluster")) <= F.array_min(far) * (1 + 1e-12)
    return assign_to(orders, cols, centers).select("o_orderkey", "o_totalprice", "o_custkey", nearest.alias("nearest"))


_SOURCES = """SELECT source, row_number() OVER (ORDER BY n DESC, source) - 1 AS i
              FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)"""


@query(
    "one_hot_sparse",
    f"""SELECT doc_id, CAST((SELECT count(*) FROM ({_SOURCES})) AS INT) AS width, CAST(i AS INT) AS place,
               CAST(1.0 AS DOUBLE) AS value
        FROM documents JOIN ({_SOURCES}) USING (source)""",
)
def sparse_encoded(spark, d):
    hot = F.col("source_index_onehot")
    return encode(table(spark, d, "documents").select("doc_id", "source"), ["source"]).select(
        "doc_id", hot["size"].alias("width"), F.get(hot["indices"], F.lit(0)).alias("place"),
        F.get(hot["values"], F.lit(0)).alias("value"),
    )
