"""Joins under null, placeholder and hot keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins as J

LEFT = (
    [("a", i) for i in range(40)] + [("b", 100)] + [(None, 200 + i) for i in range(30)]
    + [("unknown", 300 + i) for i in range(25)] + [("only_left", 400 + i) for i in range(20)] + [("x", 500)] * 3
)
RIGHT = (
    [("a", f"r{i}") for i in range(12)] + [("b", "q0"), ("b", "q1")] + [(None, "n")] * 15
    + [("unknown", f"u{i}") for i in range(14)] + [("only_right", f"o{i}") for i in range(22)]
)


def brute(how, placeholders):
    out = []
    key = lambda k: None if k in placeholders else k
    matched = set()
    for k, v in LEFT:
        hits = [j for j, (rk, _) in enumerate(RIGHT) if key(k) is not None and key(rk) == key(k)]
        out += [(k, v, RIGHT[j][1]) for j in hits] or [(k, v, None)]
        matched.update(hits)
    if how == "outer":
        out += [(rk, None, rv) for j, (rk, rv) in enumerate(RIGHT) if j not in matched]
    return Counter(out)


# no check; grid only; smaller side only; always broadcast; nothing hot
@pytest.mark.parametrize("hot_rows,few", [(None, 0), (1, 0), (10, 0), (10, 13), (1, 10_000), (10**6, 0)])
@pytest.mark.parametrize("placeholders", [(), ("unknown",)])
@pytest.mark.parametrize("how", ["left", "outer"])
def test_join_matches_brute_force(spark, monkeypatch, how, placeholders, hot_rows, few):
    monkeypatch.setattr(J, "BROADCAST_ROWS", few)
    left = spark.createDataFrame(LEFT, "name_norm string, v int").repartition(3)
    right = spark.createDataFrame(RIGHT, "name_norm string, w string").repartition(3)
    join = J.left_join if how == "left" else J.outer_join
    got = join(left, right, placeholder_keys=placeholders, hot_rows=hot_rows)
    assert got.columns == ["name_norm", "v", "w"]
    assert Counter(map(tuple, got.collect())) == brute(how, placeholders)


@pytest.mark.parametrize("few", [0, 10_000])
def test_every_hot_key_is_split_however_many_there_are(spark, monkeypatch, few):
    monkeypatch.setattr(J, "BROADCAST_ROWS", few)
    left = spark.createDataFrame([(f"k{i % 260}", i) for i in range(260 * 5)], "name_norm string, v int")
    right = spark.createDataFrame([(f"k{i % 250}", i) for i in range(250 * 4)], "name_norm string, w int")
    hot = J._hot_keys(*[df.withColumnRenamed("name_norm", "__k") for df in (left, right)], 3)
    assert hot.count() == 260
    got = J.outer_join(left, right, hot_rows=3)
    want = [(f"k{i % 260}", i, j) for i in range(1300) for j in range(i % 260, 1000, 250) if i % 260 < 250]
    want += [(f"k{i % 260}", i, None) for i in range(1300) if i % 260 >= 250]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_nested_columns_are_not_broadcast(spark):
    left = spark.createDataFrame(LEFT, "name_norm string, v int")
    right = spark.createDataFrame([(k, [w]) for k, w in RIGHT], "name_norm string, w array<string>")
    got = J.left_join(left, right, hot_rows=3).collect()
    assert Counter((k, v, w[0] if w else None) for k, v, w in got) == brute("left", ())


def test_integrate_drops_clashing_names_and_unnamed_matches(spark):
    seasons = spark.createDataFrame([(" Al ", 1), ("Unknown", 2), (None, 3)], "Player string, PTS int")
    players = spark.createDataFrame([("al", 10), ("unknown", 11)], "Player string, height int")
    data = spark.createDataFrame([("AL", 20), ("Unknown", 21), ("Bo", 22)], "name string, weight int")
    rows = J.integrate(seasons, players, data).orderBy("ss_PTS").collect()
    assert [(r["name_norm"], r["pl_height"], r["pd_weight"]) for r in rows] == [
        ("al", 10, 20), ("unknown", None, None), (None, None, None),
    ]
    parity = J.integrate(seasons, players, data, placeholder_keys=())
    assert parity.filter("ss_PTS = 2").first()["pd_weight"] == 21


def test_a_key_of_many_pairs_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_PAIRS", 2_000, raising=False)
    monkeypatch.setattr(J, "BROADCAST_MEETS", 20, raising=False)
    left = spark.createDataFrame([("unknown", i) for i in range(100)] + [("a", -1), ("b", -2)], "name_norm string, v int")
    right = spark.createDataFrame([("unknown", i) for i in range(90)] + [("a", -3), ("c", -4)], "name_norm string, w int")
    got = J.outer_join(left, right).withColumn("task", F.spark_partition_id()).collect()
    want = [("unknown", i, j) for i in range(100) for j in range(90)]
    want += [("a", -1, -3), ("b", -2, None), ("c", None, -4)]
    assert Counter(tuple(r)[:3] for r in got) == Counter(want)
    assert max(Counter(r["task"] for r in got).values()) <= 4_500


@pytest.mark.parametrize("na,nb,hot_rows,want", [
    (100, 100, 1_000, (10, 10)), (5, 5, 1_000, (1, 1)), (1_000, 4, 1_000, (40, 1)), (1_000, 4, 10, (100, 1)), (15, 60, 1_000, (2, 6)),
])
def test_cells_hold_no_more_pairs_than_allowed(spark, monkeypatch, na, nb, hot_rows, want):
    monkeypatch.setattr(J, "HOT_PAIRS", 100)
    counts = spark.createDataFrame([(na, nb)], "__na bigint, __nb bigint")
    pa, pb = counts.select(J._parts("__na", "__nb", hot_rows), J._parts("__nb", "__na", hot_rows)).first()
    assert (pa, pb) == want and na / pa * nb / pb <= 100 and max(na / pa, nb / pb) <= hot_rows
