"""Operators that take all columns in one or two readings, against the plain way."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning as K
from millrace.operators import distribution as D
from millrace.operators import encoding as En
from millrace.operators import stats as St


def watched(spark, df):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(look, df.schema), seen


def plain_filter(rows, n, limit=3.0):
    for i in range(n):
        known = [r[i] for r in rows if r[i] is not None]
        if len(known) < 2 or statistics.stdev(known) == 0:
            continue
        m, s = statistics.mean(known), statistics.stdev(known)
        rows = [r for r in rows if r[i] is not None and abs((r[i] - m) / s) <= limit]
    return rows


@pytest.mark.parametrize("at,seed", [(0.0, 1), (1e9, 2), (-1e6, 3)])
def test_outliers_column_after_column_in_two_readings(spark, at, seed):
    r = random.Random(seed)
    rows = []
    for k in range(1_500):
        row = [at + r.gauss(0, 1), at + r.expovariate(1), at + r.gauss(0, 1) ** 3, 5.0, float(r.randrange(4))]
        if k % 40 == 0:
            row[r.randrange(3)] = None
        if k % 97 == 0:
            row[r.randrange(3)] = at + r.choice([-1, 1]) * 10 ** r.randrange(1, 6)
        rows.append((k, *row))
    cols = ["a", "b", "c", "flat", "few"]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    want = plain_filter([r[1:] + (r[0],) for r in rows], 5)
    got = K.zscore_filter(df, cols)
    assert sorted(x["k"] for x in got.collect()) == sorted(w[-1] for w in want)
    source, seen = watched(spark, df)
    limits = K.outlier_limits(source, cols)
    assert [c for c, *_ in limits] == ["a", "b", "c", "few"] and seen.value <= 3 * len(rows)


def test_limits_that_close_in_are_found_again(spark):
    # One huge value hides the next ones: each column's limit shrinks far below the rough one.
    rows = [(float(i % 10), float(i % 7)) for i in range(400)] + [(1e7, 1e7), (1e7, 1e5), (2e3, 1e3), (900.0, 40.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert sorted(map(tuple, K.zscore_filter(df, ["a", "b"]).collect())) == sorted(plain_filter(rows, 2))
    odd = spark.createDataFrame([(1.0, float("nan")), (2.0, 1.0), (None, None)], "a double, b double")
    assert K.zscore_filter(odd, ["a"]).count() == 2 and K.zscore_filter(odd.limit(0), ["a", "b"]).count() == 0


@pytest.mark.parametrize("kind", ["normal", "far", "two"])
def test_density_is_the_sum_over_all_rows(spark, kind):
    r = random.Random(6)
    x = {
        "normal": [r.gauss(0, 1) for _ in range(700)],
        "far": [r.gauss(0, 1) for _ in range(300)] + [1e4, -2e3],
        "two": [1.0, 4.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in x] + [(None,), (float("nan"),)], "x double")
    h = statistics.stdev(x) * len(x) ** -0.2
    for row in D.kde(df, "x", 50).collect():
        want = sum(math.exp(-(((row["x"] - v) / h) ** 2) / 2) for v in x) / (len(x) * h * math.sqrt(2 * math.pi))
        assert row["density"] == pytest.approx(want, abs=1e-12)
    assert D.kde(df, "x", 50).count() == 50


def test_distinct_counts_of_all_columns_in_one_reading(spark):
    rows = [(i % 7, float(i % 11) if i % 5 else None, i % 3 * 1.0, None) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d int").repartition(3)
    source, seen = watched(spark, df)
    got = {r["column"]: r["n_distinct"] for r in St.distinct_counts(source, df.columns).collect()}
    assert got == {"a": 7, "b": 11, "c": 3, "d": 0} and seen.value == 500
    assert St.distinct_counts(df.limit(0), ["a"]).collect()[0]["n_distinct"] == 0


@pytest.mark.parametrize("short_list", [10_000, 1])
def test_labels_of_all_columns_are_ranked_together(spark, short_list):
    r = random.Random(9)
    rows = [(f"x{int(40 * r.random() ** 2)}", f"y{r.randrange(5)}" if r.random() < 0.8 else None, r.randrange(30)) for _ in range(600)]
    df = spark.createDataFrame(rows, "a string, b string, c int").repartition(4)
    found = En.label_ranks_of(df, ["a", "b", "c"], short_list)
    for i, c in enumerate(("a", "b", "c")):
        known = [row[i] for row in rows if row[i] is not None]
        order = sorted(set(known), key=lambda v: (-known.count(v), v))
        ranks, size, short = found[c]
        assert size == len(order) and short == (short_list > 1)
        assert {x["label"]: x["index"] for x in ranks.collect()} == {v: float(k) for k, v in enumerate(order)}
    plan = En.label_counts(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("tile,room", [(128, 64 << 20), (3, 64 << 20), (4, 900)])
def test_tiles_give_every_pair(spark, monkeypatch, tile, room):
    monkeypatch.setattr(St, "TILE", tile)
    monkeypatch.setattr(St, "TILES_BYTES", room)
    r = random.Random(11)
    width = 11
    rows = []
    for _ in range(300):
        base = r.gauss(0, 1)
        row = [1e7 + base * (c % 4) + r.gauss(0, 1) for c in range(width)]
        row[2], row[9] = (None if r.random() < 0.2 else row[2]), r.choice([row[9], float("nan"), float("inf")])
        row[5] = 3.0
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(width))).repartition(4)
    got = {(x["i"], x["j"]): x for x in St._pair_sums(df, df.columns).collect()}
    assert len(got) == width * (width + 1) // 2
    for (i, j), x in got.items():
        both = [(v[i], v[j]) for v in rows if all(y is not None and math.isfinite(y) for y in (v[i], v[j]))]
        mi, mj = (statistics.mean(v[k] for v in both) for k in (0, 1))
        assert x["n"] == len(both)
        assert x["co"] == pytest.approx(sum((a - mi) * (b - mj) for a, b in both), abs=1e-5)
        assert x["vi"] == pytest.approx(sum((a - mi) ** 2 for a, _ in both), abs=1e-5)
    assert len(St._tile_passes(width, [True] * width)) == (1 if room > 900 else 6)


@pytest.mark.parametrize("block", [100, 3, 1])
def test_nearest_class_of_any_number_of_classes(spark, block):
    from millrace.operators import clustering as Cl

    r = random.Random(12)
    rows = [(i, i % 7 if i % 11 else None, [r.gauss(i % 7, 0.8), r.gauss(0, 1)]) for i in range(150)] + [(200, 3, None)]
    df = spark.createDataFrame(rows, "id int, label int, v array<double>")
    known = [x for x in rows if x[1] is not None and x[2] is not None]
    means = {k: [statistics.mean(x[2][d] for x in known if x[1] == k) for d in (0, 1)] for k in range(7)}
    got = {x["id"]: x["cluster"] for x in Cl.nearest_class(df, "label", "v", block=block).collect()}
    for i, _, v in rows:
        want = None if v is None else min(means, key=lambda k: (sum((a - b) ** 2 for a, b in zip(v, means[k])), k))
        assert got[i] == want
