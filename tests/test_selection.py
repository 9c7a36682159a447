"""Exact quantiles of several columns and groups in two readings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import selection as S
from millrace.operators.binning import fit_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def brute(values, share, interpolate):
    values = sorted(values)
    if not interpolate:
        return values[max(math.ceil(share * len(values)) - 1, 0)]
    at = share * (len(values) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return values[lo] + (values[hi] - values[lo]) * (at - lo)


def columns(seed, n=3_000):
    r = random.Random(seed)
    return {
        "even": [r.random() for _ in range(n)],
        "steep": [math.exp(9 * r.random()) for _ in range(n)],
        "hot": [7.0] * (n // 3) + [r.random() * 9 for _ in range(n - n // 3)],
        "few": [float(r.randrange(3)) for _ in range(n)],
        "gaps": [r.choice([None, float("nan"), -0.0, 0.0, r.gauss(0, 1)]) for _ in range(n)],
        "ends": [r.choice([float("inf"), float("-inf"), r.gauss(0, 1)]) for _ in range(n)],
        "none": [None] * n,
    }


# The usual sketches; small ones, whose ranges must be narrowed; ranges that often miss.
@pytest.mark.parametrize("size,kept,wider", [(None, 4_000_000, 3.0), (64, 50, 3.0), (32, 4_000_000, 0.02)])
@pytest.mark.parametrize("interpolate", [True, False])
def test_all_columns_at_once(spark, monkeypatch, size, kept, wider, interpolate):
    monkeypatch.setattr(S, "KEPT", kept)
    monkeypatch.setattr(S, "WIDER", wider)
    data = columns(3)
    schema = ", ".join(f"{c} double" for c in data)
    df = spark.createDataFrame(list(zip(*data.values())), schema).repartition(5)
    shares = [s for s in SHARES if not (interpolate and s in (0.1, 0.9))]
    names = [c for c in data if not (interpolate and c == "ends")]
    got = {(r["column"], r["share"]): r["value"] for r in S.quantiles(df, names, shares, (), interpolate, size).collect()}
    want = {
        (c, s): brute([v for v in data[c] if v is not None and v == v], s, interpolate)
        for c in names if c != "none" for s in shares
    }
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (pytest.approx(v, abs=1e-12) if math.isfinite(v) else v), k


@pytest.mark.parametrize("kept", [4_000_000, 20])
def test_groups_and_columns_together(spark, monkeypatch, kept):
    monkeypatch.setattr(S, "KEPT", kept)
    r = random.Random(4)
    rows = [(g, r.gauss(0, 1), r.randrange(100)) for g in ("a", "b", None) for _ in range(700)] + [("c", None, 5), ("d", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y int").repartition(4)
    got = {(q["g"], q["column"], q["share"]): q["value"] for q in S.quantiles(df, ["x", "y"], [0.25, 0.5], ["g"], False, 64).collect()}
    want = {}
    for g in ("a", "b", None, "c", "d"):
        for i, c in enumerate(("x", "y")):
            values = [row[i + 1] for row in rows if row[0] == g and row[i + 1] is not None]
            want |= {(g, c, s): brute(values, s, False) for s in (0.25, 0.5) if values}
    assert got == want


def test_types_stay_where_columns_agree(spark):
    df = spark.range(1, 101).select(F.col("id").alias("a"), (F.col("id") + (1 << 60)).alias("b"))
    out = S.quantiles(df, ["a", "b"], [0.5], interpolate=False)
    assert out.schema["value"].dataType.simpleString() == "bigint"
    assert {r["column"]: r["value"] for r in out.collect()} == {"a": 50, "b": 50 + (1 << 60)}


def test_two_readings_at_any_number_of_columns(spark, tmp_path):
    """Rows read from the table, counted by the tasks themselves."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    n = 500
    df = spark.range(n).select(*[(F.col("id") * (i + 1) % 97).cast("double").alias(f"c{i}") for i in range(12)])
    watched = df.mapInArrow(look, df.schema)
    edges = fit_quantiles(watched, df.columns)
    assert seen.value == 2 * n and all(len(e) == 4 for e in edges.values())
