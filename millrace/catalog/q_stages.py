"""The preparation stages and a whole experiment, on orders and customers."""

from pyspark.sql import functions as F

from millrace.catalog.q_joins import PLAYER_DATA, PLAYERS
from millrace.catalog.q_transform import _rank_sql, squares
from millrace.catalog.registry import DOC_FEATURES, doc_features, query, rd, rounded, unit_hash_sql, view_query
from millrace.operators.clustering import kmeans_centers
from millrace.plans.stages import (
    clean_roster,
    clean_seasons,
    discretize_stage,
    integrate_stage,
    reduce_stage,
    transform_stage,
)
from millrace.plans.supervised import experiment
from millrace.session import materialize

SEASONS = """
    SELECT o_orderkey AS season,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL
                ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR(20)), 9, '0') END AS Player,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS Pos,
           o_orderstatus AS Tm,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE pow(o_totalprice / 100000, 5) END AS PTS,
           CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS Age,
           o_totalprice / 1000 AS PER,
           CAST(NULL AS VARCHAR(9)) AS blanl
    FROM orders"""

ROSTER = """
    SELECT c_name AS name, c_custkey AS id, c_acctbal AS weight,
           CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '6-' || CAST(c_custkey % 12 AS VARCHAR(9))
                              WHEN 2 THEN 'n/a' ELSE CAST(150 + c_custkey % 70 AS VARCHAR(9)) END AS height,
           CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE DATE '1990-05-01' END AS birth_date,
           CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS college
    FROM customer"""


@query(
    "stage_clean_roster",
    f"""WITH g AS (SELECT DISTINCT * FROM ({ROSTER})),
             h AS (SELECT *, CASE WHEN height LIKE '%-%' THEN 72 + CAST(split_part(height, '-', 2) AS INT)
                                  ELSE round_even(TRY_CAST(height AS DOUBLE) / 2.54, 0) END AS inches FROM g)
        SELECT name, {rd('id')} AS id, {rd('weight')} AS weight, height,
               {rd('coalesce(inches, (SELECT avg(inches) FROM h))')} AS height_in,
               strftime(coalesce(birth_date, DATE '1900-01-01'), '%Y-%m-%d') AS birth_date,
               coalesce(college, 'Unknown') AS college
        FROM h""",
)
def roster_cleaned(spark, d):
    rows = clean_roster(view_query(spark, d, ROSTER, "customer"))
    return rows.select(
        "name", rounded("id").alias("id"), rounded("weight").alias("weight"), "height",
        rounded("height_in").alias("height_in"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birth_date"), "college",
    )


_CLEANED = f"""
    g AS (SELECT DISTINCT * EXCLUDE (blanl) FROM ({SEASONS})),
    f AS (SELECT season, coalesce(Player, 'Unknown') AS Player,
                 regexp_replace(coalesce(Pos, 'Unknown'), '-.*', '') AS Pos, Tm,
                 coalesce(PTS, (SELECT avg(PTS) FROM g)) AS PTS,
                 coalesce(Age, (SELECT avg(Age) FROM g)) AS Age, PER FROM g),
    s1 AS (SELECT avg(PTS) AS m, stddev_samp(PTS) AS s FROM f),
    r1 AS (SELECT f.* FROM f, s1 WHERE abs((PTS - m) / s) <= 3),
    s2 AS (SELECT avg(Age) AS m, stddev_samp(Age) AS s FROM r1),
    r2 AS (SELECT r1.* FROM r1, s2 WHERE abs((Age - m) / s) <= 3)"""


@query(
    "stage_clean_seasons",
    f"""WITH {_CLEANED}
        SELECT {rd('season')} AS season, Player, Pos, Tm, {rd('PTS', 4)} AS "PTS", {rd('Age')} AS "Age",
               {rd('PER')} AS "PER" FROM r2""",
)
def seasons_cleaned(spark, d):
    rows = clean_seasons(view_query(spark, d, SEASONS, "orders"))
    return rows.select(
        rounded("season").alias("season"), "Player", "Pos", "Tm", rounded("PTS", 4).alias("PTS"),
        rounded("Age").alias("Age"), rounded("PER").alias("PER"),
    )


def integrated(spark, d):
    seasons = clean_seasons(view_query(spark, d, SEASONS, "orders"))
    players = clean_roster(view_query(spark, d, PLAYERS, "customer"))
    data = clean_roster(view_query(spark, d, PLAYER_DATA, "customer"))
    return integrate_stage(seasons, players, data)


# Both rosters carry the same ids, so the second id column is redundant and goes.
@query(
    "stage_integrate",
    f"""WITH {_CLEANED},
             pl AS (SELECT DISTINCT lower(Player) AS k, Player, id, balance FROM ({PLAYERS})),
             pd AS (SELECT DISTINCT lower(coalesce(name, 'Unknown')) AS k, coalesce(name, 'Unknown') AS name, id, segment
                    FROM ({PLAYER_DATA})),
             roster AS (SELECT coalesce(pl.k, pd.k) AS k, pl.Player AS pl_Player, pl.id AS pl_id,
                               pl.balance AS pl_balance, pd.name AS pd_name, pd.segment AS pd_segment
                        FROM pl FULL JOIN pd ON nullif(pl.k, 'unknown') = nullif(pd.k, 'unknown'))
        SELECT lower(Player) AS name_norm, {rd('season')} AS "ss_season", Player AS "ss_Player", Pos AS "ss_Pos",
               Tm AS "ss_Tm", {rd('PTS', 4)} AS "ss_PTS", {rd('Age')} AS "ss_Age", {rd('PER')} AS "ss_PER",
               pl_Player AS "pl_Player", pl_id, pl_balance, pd_name, pd_segment
        FROM r2 LEFT JOIN roster ON nullif(lower(Player), 'unknown') = nullif(roster.k, 'unknown')""",
)
def stage_integrated(spark, d):
    digits = {"ss_season": 6, "ss_PTS": 4, "ss_Age": 6, "ss_PER": 6}
    return integrated(spark, d).withColumns({c: rounded(c, n) for c, n in digits.items()})


@query("stage_reduce")
def stage_reduced(spark, d):
    return reduce_stage(integrated(spark, d), keep=("ss_season", "ss_PER"))


TRANSFORMED = """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderstatus
    FROM orders"""
_NUMBERS = ("o_orderkey", "o_totalprice", "o_custkey")


@query(
    "stage_transform",
    f"""WITH g AS (SELECT * FROM ({TRANSFORMED}) WHERE o_custkey IS NOT NULL),
             p AS {_rank_sql('g', 'o_orderpriority')}, s AS {_rank_sql('g', 'o_orderstatus')},
             m AS (SELECT {', '.join(f'min({c}) AS {c}_l, max({c}) AS {c}_h, avg({c}) AS {c}_a, stddev_samp({c}) AS {c}_s' for c in _NUMBERS)}
                   FROM g)
        SELECT o_orderkey, {', '.join(f"{rd(f'({c} - {c}_l) / ({c}_h - {c}_l)')} AS {c}_minmax, {rd(f'({c} - {c}_a) / {c}_s')} AS {c}_standard" for c in _NUMBERS)},
               coalesce(p.i, (SELECT count(*) FROM p)) AS o_orderpriority_index,
               coalesce(s.i, (SELECT count(*) FROM s)) AS o_orderstatus_index,
               CAST(p.i IS NOT NULL AS DOUBLE) AS priority_bits
        FROM g LEFT JOIN p USING (o_orderpriority) LEFT JOIN s USING (o_orderstatus), m""",
)
def stage_transformed(spark, d):
    rows = transform_stage(view_query(spark, d, TRANSFORMED, "orders"), sparse=False)
    bits = F.aggregate("o_orderpriority_index_onehot", F.lit(0.0), lambda a, x: a + x)
    scaled = [f"{c}_{s}" for c in _NUMBERS for s in ("minmax", "standard")]
    return rows.select(
        "o_orderkey",
        *[rounded(c).alias(c) for c in scaled],
        "o_orderpriority_index",
        "o_orderstatus_index",
        bits.alias("priority_bits"),
    )


_BINNED = ("PTS", "Age", "PER")


def _quantile_sql(c):
    steps = " + ".join(f"CASE WHEN {c} >= {c}_q[{i}] THEN 1.0 ELSE 0.0 END" for i in range(1, 5))
    return f"CAST({steps} AS DOUBLE) AS {c}_quantile"


@query(
    "stage_discretize",
    f"""WITH g AS (SELECT season, coalesce(PTS, 0.0) AS PTS, coalesce(Age, 0.0) AS Age, PER FROM ({SEASONS}))
        SELECT season, {rd('PER')} AS per,
               {', '.join(f"least(floor(({c} - {c}_l) / (({c}_h - {c}_l) / 5)), 4) + 0.0 AS {c}_equal_width" for c in _BINNED)},
               {', '.join(_quantile_sql(c) for c in _BINNED)}, true AS nearest
        FROM g, (SELECT {', '.join(f'min({c}) AS {c}_l, max({c}) AS {c}_h, quantile_disc({c}, [0.2, 0.4, 0.6, 0.8]) AS {c}_q' for c in _BINNED)} FROM g)""",
)
def stage_discretized(spark, d):
    """Bins of both kinds, and whether the cluster is that of the centre next to the row."""
    rows = view_query(spark, d, SEASONS, "orders").na.fill(0.0, ["PTS", "Age"])
    out = discretize_stage(rows.drop("blanl"), key="season", targets=["PER"])
    bins = [F.col(f"{c}_{kind}") for kind in ("equal_width", "quantile") for c in _BINNED]
    cols = ["PTS", "Age"]
    far = F.array(*[squares(cols, c) for c in kmeans_centers(rows, cols)])
    nearest = F.get(far, F.col("player_cluster")) <= F.array_min(far) * (1 + 1e-9)
    return out.select("season", rounded("PER").alias("per"), *bins, nearest.alias("nearest"))


def chain(spark, d):
    """Clean, join, label, split, fit, report."""
    joined = materialize(reduce_stage(integrated(spark, d), keep=("ss_season", "ss_PER")), "reduced")
    return experiment(
        joined, "logistic", targets=("ss_PER",), key="ss_season", classes=["below", "above"]
    ).report


@query("experiment_logistic")
def experiment_report(spark, d):
    return chain(spark, d)


# Whatever the model, the supports of its report follow from the label and the split.
@query(
    "experiment_support",
    f"""WITH g AS ({DOC_FEATURES})
        SELECT CASE WHEN n_chars >= (SELECT avg(n_chars) FROM g) THEN 'long' ELSE 'short' END AS name,
               count(*) AS support
        FROM g WHERE {unit_hash_sql('doc_id')} >= 0.8 GROUP BY 1""",
)
def experiment_support(spark, d):
    out = experiment(doc_features(spark, d), "tree", target="n_chars", key="doc_id", classes=["short", "long"])
    return out.report.filter("position < 2").select("name", "support")
