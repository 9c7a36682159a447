"""Key normalisation and joins. Orders stand in for seasons, customers for the two rosters."""

from pyspark.sql import functions as F

from millrace.catalog.registry import query, view_query
from millrace.functions.columns import prefix_columns
from millrace.functions.scalars import normalize_key
from millrace.operators.joins import integrate, left_join, outer_join, with_key

NAMES = """
    SELECT c_custkey,
           CASE c_custkey % 7
                WHEN 0 THEN upper(c_name)
                WHEN 1 THEN '  ' || c_name || chr(9)
                WHEN 2 THEN chr(10) || c_name || ' ' || chr(8195)
                WHEN 3 THEN ''
                WHEN 4 THEN NULL
                WHEN 5 THEN '   '
                ELSE c_name END AS c_name
    FROM customer"""
_SPACES = "' ' || chr(9) || chr(10) || chr(8195)"


def _norm(col: str) -> str:
    return f"CASE WHEN {col} <> '' THEN trim(lower({col}), {_SPACES}) END"


@query("normalize_key", f"SELECT c_custkey, {_norm('c_name')} AS name_norm FROM ({NAMES})")
def keys(spark, d):
    names = view_query(
        spark, d, NAMES.replace("chr(8195)", "decode(unhex('E28083'), 'UTF-8')"), "customer"
    )
    return names.select("c_custkey", normalize_key(F.col("c_name")).alias("name_norm"))


# Every 17th order has no name, every 19th the placeholder, every 5th a differently written name.
SEASONS = """
    SELECT o_orderkey, o_totalprice AS score,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL
                WHEN o_orderkey % 19 = 0 THEN 'Unknown'
                WHEN o_orderkey % 5 = 0 THEN '  ' || upper('Customer#' || lpad(CAST(o_custkey AS VARCHAR(20)), 9, '0'))
                ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR(20)), 9, '0') END AS Player
    FROM orders"""
PLAYERS = """
    SELECT CASE WHEN c_custkey % 29 = 0 THEN 'Unknown' ELSE c_name END AS Player,
           CAST(c_custkey AS DOUBLE) AS id, c_acctbal AS balance
    FROM customer WHERE c_custkey % 3 <> 0"""
PLAYER_DATA = """
    SELECT CASE WHEN c_custkey % 31 = 0 THEN 'Unknown' WHEN c_custkey % 37 = 0 THEN NULL ELSE c_name END AS name,
           CAST(c_custkey AS DOUBLE) AS id, c_mktsegment AS segment
    FROM customer WHERE c_custkey % 3 <> 1"""


def join_inputs(spark, d):
    return (
        view_query(spark, d, SEASONS, "orders"),
        view_query(spark, d, PLAYERS, "customer"),
        view_query(spark, d, PLAYER_DATA, "customer"),
    )


def _match(alias: str) -> str:
    return f"nullif({alias}.name_norm, 'unknown')"


_CTES = f"""
    ss AS (SELECT {_norm('Player')} AS name_norm, o_orderkey AS ss_o_orderkey, score AS ss_score,
                  Player AS ss_Player FROM ({SEASONS})),
    pl AS (SELECT {_norm('Player')} AS name_norm, Player AS pl_Player, id AS pl_id, balance AS pl_balance
           FROM ({PLAYERS})),
    pd AS (SELECT {_norm('name')} AS name_norm, name AS pd_name, id AS pd_id, segment AS pd_segment
           FROM ({PLAYER_DATA}))"""
_ROSTER = f"""
    SELECT coalesce(pl.name_norm, pd.name_norm) AS name_norm, pl_Player, pl_id, pl_balance,
           pd_name, pd_id, pd_segment
    FROM pl FULL JOIN pd ON {_match('pl')} = {_match('pd')}"""


def _sides(spark, d):
    seasons, players, data = join_inputs(spark, d)
    return (
        prefix_columns(with_key(seasons, "Player"), "ss_"),
        prefix_columns(with_key(players, "Player"), "pl_"),
        prefix_columns(with_key(data, "name"), "pd_"),
    )


@query("outer_join", f"WITH {_CTES} {_ROSTER}")
def roster(spark, d):
    _, players, data = _sides(spark, d)
    return outer_join(players, data, placeholder_keys=("unknown",))


@query(
    "outer_join_parity",
    f"""WITH {_CTES} SELECT name_norm, count(*) AS n, count(pl_id) AS n_pl, count(pd_id) AS n_pd
        FROM ({_ROSTER.replace(_match('pl'), 'pl.name_norm').replace(_match('pd'), 'pd.name_norm')})
        GROUP BY name_norm""",
)
def roster_parity(spark, d):
    _, players, data = _sides(spark, d)
    return (
        outer_join(players, data)
        .groupBy("name_norm")
        .agg(F.count(F.lit(1)).alias("n"), F.count("pl_id").alias("n_pl"), F.count("pd_id").alias("n_pd"))
    )


@query(
    "left_join",
    f"""WITH {_CTES} SELECT ss.name_norm, ss_o_orderkey, ss_score, ss_Player, pl_Player, pl_id, pl_balance
        FROM ss LEFT JOIN pl ON {_match('ss')} = {_match('pl')}""",
)
def seasons_players(spark, d):
    seasons, players, _ = _sides(spark, d)
    return left_join(seasons, players, placeholder_keys=("unknown",))


_INTEGRATED = f"""WITH {_CTES}, roster AS ({_ROSTER})
        SELECT ss.name_norm, ss_o_orderkey, ss_score, ss_Player, pl_Player, pl_id, pl_balance,
               pd_name, pd_id, pd_segment
        FROM ss LEFT JOIN roster ON {_match('ss')} = {_match('roster')}"""


@query("integrate", _INTEGRATED)
def integrated(spark, d):
    return integrate(*join_inputs(spark, d))


@query("integrate_hot_keys", _INTEGRATED)
def integrated_hot(spark, d):
    """Same result when every customer with over 15 orders counts as a hot key."""
    return integrate(*join_inputs(spark, d), hot_rows=15)
