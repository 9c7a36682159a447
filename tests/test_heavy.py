"""Frequent keys by mergeable summaries: none over the limit is missing."""

import random
from collections import Counter

import pytest

from millrace.operators import heavy as H


def skewed(n, keys, seed):
    r = random.Random(seed)
    return [f"k{int(keys * r.random() ** 3)}" for _ in range(n)]


def as_dict(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed,keys,limit,size", [(1, 5_000, 400, 512), (2, 300, 150, 1024), (3, 20_000, 2_000, 128), (4, 7, 100, 256)])
def test_no_key_over_the_limit_escapes(spark, monkeypatch, seed, keys, limit, size):
    monkeypatch.setattr(H, "FIRST_SIZE", size)
    rows = skewed(20_000, keys, seed) + [None] * (limit + seed % 2)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(k,) for k in rows], "k string").repartition(7)
    count = Counter(rows)
    want = {k: n for k, n in count.items() if n > limit}
    found, nulls = H.candidates(df, "k", limit)
    assert nulls == count[None] and {r[0] for r in found.collect()} >= set(want) - {None}
    assert as_dict(H.frequent_keys(df, "k", limit)) == {k: (n,) for k, n in want.items()}


def test_counts_of_both_sides(spark):
    a = [1] * 30 + [2] * 5 + [3] * 11 + [None] * 4
    b = [1] * 2 + [2] * 20 + [4] * 12 + [None] * 40
    frames = [spark.createDataFrame([(k,) for k in rows], "k int").repartition(3) for rows in (a, b)]
    assert as_dict(H.frequent_in_either(*frames, "k", 10)) == {1: (30, 2), 2: (5, 20), 3: (11, 0), 4: (0, 12), None: (4, 40)}
    assert H.frequent_in_either(*frames, "k", 100) is None
    assert as_dict(H.frequent_in_either(*frames, "k", 30)) == {None: (4, 40)}


def test_keys_of_many_pairs(spark):
    a = [1] * 30 + [2] * 5 + [3] * 11 + [None] * 40
    b = [1] * 2 + [2] * 20 + [4] * 12 + [None] * 40
    frames = [spark.createDataFrame([(k,) for k in rows], "k int").repartition(3) for rows in (a, b)]
    assert as_dict(H.frequent_in_either(*frames, "k", 100, pairs=60)) == {2: (5, 20)}
    assert as_dict(H.frequent_in_either(*frames, "k", 100, pairs=59)) == {1: (30, 2), 2: (5, 20)}
    assert H.frequent_in_either(*frames, "k", 100, pairs=100) is None


def test_a_wanted_size_that_no_summary_tells_is_raised(spark, monkeypatch):
    monkeypatch.setattr(H, "FIRST_SIZE", 16)
    monkeypatch.setattr(H, "LARGEST_SIZE", 64)
    keys = ["a"] * 500 + ["b"] * 350 + [f"k{i}" for i in range(2_150)]
    random.Random(7).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    found, _ = H.candidates(df, "k", 400, 3)
    assert {"a", "b"} <= {r[0] for r in found.collect()}
    assert H.candidates(df, "k", 300, 3)[0] is None


def test_empty_tables_and_keys_that_no_summary_takes(spark):
    none = spark.createDataFrame([], "k string")
    assert H.frequent_keys(none, "k", 5).count() == 0 and H.frequent_in_either(none, none, "k", 5) is None
    pairs = spark.createDataFrame([((1, 2),)] * 9 + [((3, 4),)], "k struct<a:int,b:int>")
    assert [tuple(r) for r in H.frequent_keys(pairs, "k", 5).collect()] == [((1, 2), 9)]


def test_a_summary_too_small_for_the_limit_is_not_trusted(spark, monkeypatch):
    monkeypatch.setattr(H, "FIRST_SIZE", 16)
    monkeypatch.setattr(H, "LARGEST_SIZE", 64)
    rows = skewed(3_000, 900, 5)
    df = spark.createDataFrame([(k,) for k in rows], "k string")
    want = {k: (n,) for k, n in Counter(rows).items() if n > 3}
    assert as_dict(H.frequent_keys(df, "k", 3)) == want


def test_no_exchange_by_key(spark):
    df = spark.createDataFrame([("a",), ("b",)], "name string")
    plan = H.summary(df, "name", 1024)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("__g" in x or "SinglePartition" in x for x in exchanges)


def test_more_parts_than_groups(spark):
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in names}
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 2 + [(None,)] * 3, "k string").repartition(2)
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        assert as_dict(H.frequent_keys(df, "k", 4)) == {"a": (9,)}
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
