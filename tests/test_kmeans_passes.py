"""A pass over the blocks is one job, whatever the number of parts."""

import random

import numpy as np

from millrace.operators import joint_kmeans as J


def test_a_pass_reads_all_parts_in_one_job(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(4_000)], "a double, b double")
    stored = J.blocks(df.repartition(23), ["a", "b"])
    centers = {k: np.array([(float(i), 0.5) for i in range(k)]) for k in (2, 3)}
    context = spark.sparkContext
    context.setJobGroup("one-pass", "a pass")
    try:
        sums = J._pass(stored, centers)
    finally:
        context._jsc.clearJobGroup()
    jobs = context.statusTracker().getJobIdsForGroup("one-pass")
    # With adaptive execution the shuffle is a job of its own.
    assert len(jobs) <= 3
    assert sums.n[2].sum() == sums.n[3].sum() == 4_000


def test_sums_do_not_depend_on_the_parts_that_add_up(spark, monkeypatch):
    r = random.Random(4)
    rows = [(r.gauss(0, 5), r.gauss(0, 5)) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(9).cache()
    centers = {3: np.array([(-3.0, 0.0), (0.0, 2.0), (4.0, 0.0)])}
    whole = J._pass(J.blocks(df, ["a", "b"]), centers)
    monkeypatch.setattr(J, "ADDING", 2)
    monkeypatch.setattr(J, "GATHERED", 1)
    few = J._pass(J.blocks(df, ["a", "b"]), centers)
    x = np.array(rows)
    own = ((x[:, None] - centers[3]) ** 2).sum(2).argmin(1)
    for sums in (whole, few):
        assert (sums.n[3] == np.bincount(own, minlength=3)).all()
        assert np.abs(sums.total[3] - [x[own == i].sum(0) for i in range(3)]).max() < 1e-8
