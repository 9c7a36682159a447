"""The wide forest learns the classes of the table."""

import hashlib
import random

from millrace.catalog import QUERIES


def test_the_label_is_the_half_of_the_classes(spark, tmp_path):
    rng = random.Random(5)
    # What the first two features add up to says nothing of the class, and is never negative.
    rows = [(i, i % 7, [abs(rng.gauss(0, 1)) for _ in range(64)]) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    table.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    want = {0: 0, 1: 0}
    for i, label, _ in rows:
        if int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) / 2**32 >= 0.8:
            want[int(label >= 5)] += 1
    got = QUERIES["train_forest_wide"](spark, str(tmp_path)).collect()
    assert {r["label"]: r["support"] for r in got} == want
    assert all(r["sums_to_one"] and r["beats_majority"] and r["disagreements"] == 0 for r in got)
