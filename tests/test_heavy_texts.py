"""Summaries of long texts."""

from collections import Counter

import pytest

from millrace.operators import heavy as H


@pytest.mark.parametrize("length", [10, 2_000])
def test_a_summary_does_not_grow_with_the_texts(spark, length):
    rows = [(f"{i:0{length}d}",) for i in range(500)]
    top = H.summary(spark.createDataFrame(rows, "k string"), "k", 1024).first()["top"]
    assert len(top) == 500 and sum(len(str(t["item"])) for t in top) < 500 * 21


def test_long_texts_are_counted_whole(spark):
    # They differ in their last letter only.
    texts = ["x" * 5_000 + c for c in "abc"] + [None, "", "y"]
    rows = [texts[i % 6] for i in range(60)] + [texts[0]] * 30 + [""] * 20
    df = spark.createDataFrame([(t,) for t in rows], "k string").repartition(5)
    want = {t: n for t, n in Counter(rows).items() if n > 15}
    assert {r["k"]: r["n"] for r in H.frequent_keys(df, "k", 15).collect()} == want == {texts[0]: 40, "": 30}
