import math
import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from millrace.llm import hard_negatives

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
     T.StructField("label", T.IntegerType()), T.StructField("row", T.StringType()), T.StructField("v", T.StringType())]
)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 21), st.integers(1, 30), st.integers(1, 30), st.integers(1, 1 << 20), st.integers(0, 99))
def test_scores_are_exact(dims, anchors, candidates, size, seed):
    r = np.random.default_rng(seed)
    a = r.integers(-size, size + 1, (anchors, dims)).astype(np.int32)
    c = r.integers(-size, size // 2 + 1, (candidates, dims)).astype(np.int32)
    planes, least = hard_negatives.bit_planes(c)
    tables = hard_negatives.subset_sums(a, hard_negatives.score_type(a, len(planes)))
    got = hard_negatives.scores(tables, a.astype(np.int64).sum(1), planes, least, slice(0, candidates))
    assert (got == c.astype(np.int64) @ a.astype(np.int64).T).all()


def vectors(n=260, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        v = [r.gauss(0.3, 0.4) for _ in range(11)]
        rows.append((i, v, r.randrange(3)))
    same = [0.25] * 11
    rows += [(1000 + i, same, i % 4) for i in range(60)]
    rows += [(50, rows[7][1], rows[7][2])] * 2  # repeated rows, an anchor and its copy
    rows += [
        (None, same, 1), (2001, None, 1), (2002, same, None), (2003, [0.1, None], 1), (2004, [math.nan] * 11, 1),
        (2005, [math.inf] * 11, 1), (2006, [], 1), (2050, [], 1), (2007, [0.5, 0.5], 2), (2100, [-0.5] * 11, 2),
        (2150, [3e38] + [0.0] * 10, 9), (2200, same, 77),
    ]
    return rows


def brute(rows, step=50):
    kept = []
    for row, (key, v, label) in enumerate(rows):
        if key is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        most = hard_negatives.LARGEST
        kept.append((row, key, label, [max(-most, min(most, math.floor(256 * float(np.float32(x))))) for x in v]))
    out = []
    for row, key, label, v in kept:
        if key % step:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w)), k, r, lab) for r, k, lab, w in kept)
        for s, k, r, lab in [x for x in ranked if x[3] == label and x[2] != row][:5]:
            inside = [x for x in ranked if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(key, k, i + 1, x[1], -s, -x[0]) for i, x in enumerate(inside)]
    return sorted(out)


def stored(spark, path, rows, parts=5):
    full = [(*r, "x", "y") for r in rows]
    spark.createDataFrame(full, SCHEMA).repartition(parts).write.parquet(str(path))
    return spark.read.schema(SCHEMA).parquet(str(path))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_mining_matches_brute_force(spark, tmp_path, monkeypatch):
    table = stored(spark, tmp_path / "v", vectors())
    want = brute(vectors())
    groups = defaultdict(int)
    for r in want:
        groups[r[:2]] += 1
    assert len(want) > 100 and max(groups.values()) >= 10
    assert found(hard_negatives.mine(table, lambda k: k % 50 == 0)) == want
    # Several blocks of anchors, several tables, few candidates at once.
    for name, value in {"BLOCK_BYTES": 2_000, "TABLES": 2, "CHUNK": 7, "HELD": 40}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    assert found(hard_negatives.mine(table, lambda k: k % 50 == 0)) == want


def test_no_rows_and_no_anchors(spark, tmp_path):
    none = stored(spark, tmp_path / "none", [])
    out = hard_negatives.mine(none, lambda k: k % 100 == 0)
    assert out.count() == 0 and out.schema["rank"].dataType == T.IntegerType()
    some = stored(spark, tmp_path / "some", [(1, [0.1], 1), (2, [0.1], 1)])
    assert hard_negatives.mine(some, lambda k: k % 100 == 0).count() == 0
