"""Left and full outer joins on one key that stay balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import (
    JOIN_KEY,
    drop_duplicate_columns,
    prefix_columns,
    ref,
)
from millrace.functions.scalars import normalize_key
from millrace.operators.heavy import frequent_in_either
from millrace.session import broadcast_small, materialize

# Fixed value: the key that rows without a name end up with after cleaning.
PLACEHOLDER_KEYS = ("unknown",)
# Rows of one key beyond which it is joined in parts of that many rows.
HOT_ROWS = 2_000_000
# Pairs of rows of one key beyond which it is joined in parts of that many pairs.
HOT_PAIRS = 1 << 24
BROADCAST_ROWS = 10_000
# Rows of a broadcast side that one row may meet: the other side stays in the tasks that read it.
BROADCAST_MEETS = 1_000
# Tasks of a grid at most, unless Spark's own number is higher.
GRID_TASKS = 4_096


def _match_key(key: str, placeholders: Sequence[str]) -> Column:
    c = ref(key)
    return F.when(~c.isin(*placeholders), c) if placeholders else c


def _hot_keys(a: DataFrame, b: DataFrame, hot_rows: int) -> DataFrame | None:
    """``(__k, __na, __nb)`` of every match key (null among them) with over ``hot_rows`` rows on
    either side or over ``HOT_PAIRS`` pairs, with its rows on both; None when there is no such key."""
    found = frequent_in_either(a, b, "__k", hot_rows, HOT_PAIRS)
    return None if found is None else found.withColumnsRenamed({"na": "__na", "nb": "__nb"})


def _join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    placeholder_keys: Sequence[str],
    hot_rows: int | None,
) -> DataFrame:
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    a = left.select(
        _match_key(key, placeholder_keys).alias("__k"),
        ref(key).alias("__lk"),
        *[ref(c).alias(f"__l{i}") for i, c in enumerate(lcols)],
    )
    b = right.select(
        _match_key(key, placeholder_keys).alias("__k"),
        ref(key).alias("__rk"),
        *[ref(c).alias(f"__r{i}") for i, c in enumerate(rcols)],
    )

    def shaped(df: DataFrame) -> DataFrame:
        def side(name: str, like: DataFrame) -> Column:
            return F.col(name) if name in df.columns else F.lit(None).cast(like.schema[name].dataType)

        return df.select(
            F.coalesce(side("__lk", a), side("__rk", b)).alias(key),
            *[side(f"__l{i}", a).alias(c) for i, c in enumerate(lcols)],
            *[side(f"__r{i}", b).alias(c) for i, c in enumerate(rcols)],
        )

    if hot_rows is None:
        return shaped(a.join(b, "__k", how))

    found = _hot_keys(a.select("__k"), b.select("__k"), hot_rows)
    if found is None:
        return shaped(a.join(b, "__k", how))
    # However many hot keys there are, each is known; a short list is sent to all tasks.
    hot = broadcast_small(found.filter("__k is not null"), BROADCAST_ROWS)
    a_all, b_all = a.join(hot, "__k", "left"), b.join(hot, "__k", "left")
    usual = "__k is not null and __na is null"
    alone = "__k is null or __na = 0 or __nb = 0"
    parts = [shaped(a_all.filter(usual).drop("__na", "__nb").join(b_all.filter(usual).drop("__na", "__nb"), "__k", how))]
    # rows that cannot match need no shuffle at all
    parts.append(shaped(a_all.filter(alone)))
    if how == "outer":
        parts.append(shaped(b_all.filter(alone)))
    shared = "__na > 0 and __nb > 0"
    n = found.filter("__k is not null").filter(shared).agg(
        F.sum("__na"), F.sum("__nb"), F.max("__na"), F.max("__nb"),
        F.sum(_parts("__na", "__nb", hot_rows) * _parts("__nb", "__na", hot_rows)),
    ).first()
    if n[0]:
        # the left key is that of the pair
        parts.append(shaped(_hot_join(a_all.filter(shared), b_all.filter(shared).drop("__rk"), n, hot_rows)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _parts(own: str, other: str, hot_rows: int) -> Column:
    """Parts that the rows of a key are cut into on one side, so that with the parts of the
    other side no cell has over ``hot_rows`` rows of a side or over ``HOT_PAIRS`` pairs."""
    met = F.least(F.col(other), F.lit(isqrt(HOT_PAIRS)))
    rows = F.least(F.lit(float(hot_rows)), F.lit(float(HOT_PAIRS)) / met)
    return F.ceil(F.col(own) / rows)


def _hot_join(left: DataFrame, right: DataFrame, n: Sequence[float], hot_rows: int) -> DataFrame:
    """Inner join of hot keys: the side with few and short rows is broadcast, so that the
    other one is not shuffled; with many rows on both sides they meet in a grid.

    ``n`` holds the rows of both sides, those of their largest keys, and the cells of the grid.
    """
    n_left, n_right, most_left, most_right, cells = n
    plain = [df.drop("__na", "__nb") for df in (left, right)]
    for few, rows, most, many in (
        (plain[1], n_right, most_right, plain[0]),
        (plain[0], n_left, most_left, plain[1]),
    ):
        if rows <= BROADCAST_ROWS and most <= BROADCAST_MEETS:
            small = broadcast_small(few, BROADCAST_ROWS)
            if small is not few:
                return many.join(small, "__k", "inner")
    return _grid_join(left, right, hot_rows, cells)


def _grid_join(left: DataFrame, right: DataFrame, hot_rows: int, cells: int) -> DataFrame:
    """Inner join of hot keys: the rows of a key are cut into parts on both sides, as many
    as its counts ask for, and every part meets every part of the other side in a cell of
    its own.

    The random part numbers are written down first, so that a repeated task
    cannot draw other ones. Twice as many tasks as cells leave most cells alone in a task; the
    number is given, as Spark's own choice goes by bytes and not by pairs.
    """
    usual = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, min(2 * cells, GRID_TASKS))

    def drawn(df: DataFrame, seed: int, own: str, other: str, name: str) -> DataFrame:
        part = F.floor(F.rand(seed) * _parts(own, other, hot_rows)).cast("int")
        return materialize(df.withColumn(name, part), "hot-rows")

    def dealt(df: DataFrame, own: str, other: str, name: str) -> DataFrame:
        every = F.sequence(F.lit(0), (_parts(own, other, hot_rows) - 1).cast("int"))
        return df.withColumn(name, F.explode(every)).drop("__na", "__nb").repartition(tasks, "__k", "__i", "__j")

    a = dealt(drawn(left, 42, "__na", "__nb", "__i"), "__nb", "__na", "__j")
    b = dealt(drawn(right, 43, "__nb", "__na", "__j"), "__na", "__nb", "__i")
    return a.join(b.hint("merge"), ["__k", "__i", "__j"], "inner")


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str = JOIN_KEY,
    placeholder_keys: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left outer join; null and placeholder keys match nothing.

    The skew check reads the keys of both sides beforehand, without a shuffle of keys, so
    costly inputs should be stored tables; ``hot_rows=None`` skips it.
    """
    return _join(left, right, key, "left", placeholder_keys, hot_rows)


def outer_join(
    left: DataFrame,
    right: DataFrame,
    key: str = JOIN_KEY,
    placeholder_keys: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Full outer join with one merged key column; null and placeholder keys match nothing."""
    return _join(left, right, key, "outer", placeholder_keys, hot_rows)


def with_key(df: DataFrame, name: str, key: str = JOIN_KEY) -> DataFrame:
    """Add the normalised join key when the name column exists."""
    return df.withColumn(key, normalize_key(ref(name))) if name in df.columns else df


def integrate(
    seasons: DataFrame,
    players: DataFrame,
    player_data: DataFrame,
    names: tuple[str, str, str] = ("Player", "Player", "name"),
    placeholder_keys: Sequence[str] = PLACEHOLDER_KEYS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Seasons joined to the roster that merges both player tables.

    ``placeholder_keys=()`` lets all unnamed rows match each other.
    """
    ss = prefix_columns(with_key(seasons, names[0]), "ss_")
    pl = prefix_columns(with_key(players, names[1]), "pl_")
    pd = prefix_columns(with_key(player_data, names[2]), "pd_")
    roster = outer_join(pl, pd, placeholder_keys=placeholder_keys, hot_rows=hot_rows)
    if hot_rows is not None:
        # read twice: for its frequent keys and for the join
        roster = materialize(roster, "roster")
    joined = left_join(ss, roster, placeholder_keys=placeholder_keys, hot_rows=hot_rows)
    return drop_duplicate_columns(joined)
