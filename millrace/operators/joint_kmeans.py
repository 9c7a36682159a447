"""K-means for several cluster counts at once.

Rows are packed into blocks of near points, each with its box, mean and scatter. One reading
of the blocks moves the centres of all cluster counts: a task adds up one table of sums for
all centres. A block whose box lies nearer to one centre than to any other as a whole goes to
that centre by its mean and scatter alone; only the rows of the others are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize

#: Rows of a block, at most.
BLOCK = 256
#: Bytes of numbers that a task gathers before it cuts them into blocks.
GATHERED = 16 << 20
#: Tasks, at most, that add up the sums of all others; the driver gets a row from each of these only.
ADDING = 64
#: Rows that the first centres are drawn from.
SAMPLE = 4_096
#: Centres that move less than this have arrived.
TOLERANCE = 1e-4


@dataclass
class Fit:
    """Centres of one cluster count, the rows next to each, the sum of squared distances, and
    how often the centres were moved."""

    centers: np.ndarray
    sizes: np.ndarray
    cost: float
    iterations: int


def _cut(points: np.ndarray) -> list[np.ndarray]:
    """Halves along the widest side, until a block has at most ``BLOCK`` rows."""
    todo, out = [points], []
    while todo:
        p = todo.pop()
        if len(p) <= BLOCK:
            out.append(p)
            continue
        side = int(np.argmax(p.max(0) - p.min(0)))
        order = np.argpartition(p[:, side], len(p) // 2)
        todo += [p[order[: len(p) // 2]], p[order[len(p) // 2 :]]]
    return out


def blocks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``n``, ``low``, ``high``, ``mean``, ``scatter`` and ``points`` of blocks of complete rows,
    arrays packed; rows with a missing or non-finite number are left out."""
    d = len(cols)

    def laid(parts):
        cut = [p for p in _cut(np.concatenate(parts)) if len(p)]
        mean = [p.mean(0) for p in cut]
        packed = lambda a: pa.array([v.tobytes() for v in a], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([len(p) for p in cut], pa.int64()), packed([p.min(0) for p in cut]), packed([p.max(0) for p in cut]),
             packed(mean), pa.array([float(((p - m) ** 2).sum()) for p, m in zip(cut, mean)], pa.float64()), packed(cut)],
            ["n", "low", "high", "mean", "scatter", "points"],
        )

    def run(batches):
        # The more rows are cut at once, the smaller are the boxes.
        held, size = [], 0
        for batch in batches:
            x = np.empty((batch.num_rows, d))
            for i in range(d):
                x[:, i] = batch.column(i).to_numpy(zero_copy_only=False)
            held.append(x[np.isfinite(x).all(1)])
            size += held[-1].nbytes
            if size >= GATHERED:
                yield laid(held)
                held, size = [], 0
        if size:
            yield laid(held)

    numbers = [ref(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]
    kind = "n bigint, low binary, high binary, mean binary, scatter double, points binary"
    return df.select(*numbers).mapInArrow(run, kind)


def owners(low: np.ndarray, high: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """For each box the centre that is nearest to all its points, or -1 when several may be."""
    middle = (low + high) / 2
    nearest = ((middle[:, None] - centers) ** 2).sum(2).argmin(1)
    best = centers[nearest]
    # The point of the box that is most in favour of the other centre.
    corner = np.where(centers[None] > best[:, None], high[:, None], low[:, None])
    apart = ((corner - centers[None]) ** 2).sum(2) > ((corner - best[:, None]) ** 2).sum(2)
    apart[np.arange(len(low)), nearest] = True
    return np.where(apart.all(1), nearest, -1)


class Sums:
    """Rows, coordinate sums and cost for all centres of all cluster counts."""

    def __init__(self, centers: dict[int, np.ndarray]):
        self.centers = centers
        self.n = {k: np.zeros(len(c), np.int64) for k, c in centers.items()}
        self.total = {k: np.zeros_like(c) for k, c in centers.items()}
        self.cost = dict.fromkeys(centers, 0.0)
        self.looked = 0

    def add(self, batch: pa.RecordBatch) -> None:
        n = batch.column(0).to_numpy()
        d = next(iter(self.centers.values())).shape[1]
        low, high, mean = (np.frombuffer(b"".join(batch.column(i).to_pylist())).reshape(-1, d) for i in (1, 2, 3))
        scatter = batch.column(4).to_numpy()
        points = batch.column(5)
        read: dict[int, np.ndarray] = {}
        for k, c in self.centers.items():
            owner = owners(low, high, c)
            whole = np.flatnonzero(owner >= 0)
            np.add.at(self.n[k], owner[whole], n[whole])
            np.add.at(self.total[k], owner[whole], n[whole, None] * mean[whole])
            away = ((mean[whole] - c[owner[whole]]) ** 2).sum(1)
            self.cost[k] += float((scatter[whole] + n[whole] * away).sum())
            for b in np.flatnonzero(owner < 0).tolist():
                if b not in read:
                    read[b] = np.frombuffer(points[b].as_py()).reshape(-1, d)
                self._rows(k, c, read[b], mean[b])
        self.looked += sum(map(len, read.values()))

    def _rows(self, k: int, c: np.ndarray, x: np.ndarray, mean: np.ndarray) -> None:
        # Around the block's mean, so that no digits are lost.
        near, to = x - mean, c - mean
        squares = (near**2).sum(1)[:, None] - 2 * near @ to.T + (to**2).sum(1)
        own = squares.argmin(1)
        self.n[k] += np.bincount(own, minlength=len(c))
        np.add.at(self.total[k], own, x)
        self.cost[k] += float(((x - c[own]) ** 2).sum())


    def state(self) -> list:
        """The sums packed into one row, in the order of ``STATE``."""
        ks = sorted(self.centers)
        n, total = (b"".join(a[k].tobytes() for k in ks) for a in (self.n, self.total))
        return [n, total, [self.cost[k] for k in ks], self.looked]

    def join(self, n: bytes, total: bytes, costs: Sequence[float], looked: int) -> None:
        """Add the sums of another task."""
        rows, numbers, at = np.frombuffer(n, np.int64), np.frombuffer(total), 0
        for k, cost in zip(sorted(self.centers), costs):
            d = self.centers[k].shape[1]
            self.n[k] += rows[at : at + k]
            self.total[k] += numbers[at * d : (at + k) * d].reshape(k, d)
            self.cost[k] += cost
            at += k
        self.looked += looked


STATE = "n binary, total binary, cost array<double>, looked bigint"


def _pass(stored: DataFrame, centers: dict[int, np.ndarray]) -> Sums:
    """One reading of all blocks, in all tasks at once; every task gives one row, which others
    add up, in the order of the tasks."""

    def packed(sums):
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in sums.state()], ["n", "total", "cost", "looked"])

    def read(batches):
        sums = Sums(centers)
        for batch in batches:
            if batch.num_rows:
                sums.add(batch)
        yield packed(sums)

    def add(batches):
        sums = Sums(centers)
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                sums.join(*row)
        yield packed(sums)

    each = stored.mapInArrow(read, STATE).withColumn("task", F.spark_partition_id())
    turn = F.pmod("task", F.lit(ADDING))
    ordered = each.repartition(turn).sortWithinPartitions(turn, "task")
    out = Sums(centers)
    for r in ordered.select("n", "total", "cost", "looked").mapInArrow(add, STATE).collect():
        out.join(*r)
    return out


def first_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over a sample; fewer different points than ``k`` give equal centres."""
    r = np.random.default_rng(seed)
    chosen = [sample[r.integers(len(sample))]]
    away = ((sample - chosen[0]) ** 2).sum(1)
    for _ in range(k - 1):
        total = away.sum()
        at = r.integers(len(sample)) if total <= 0 else min(int(np.searchsorted(np.cumsum(away), r.random() * total)), len(sample) - 1)
        chosen.append(sample[at])
        away = np.minimum(away, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def _sample(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """``SAMPLE`` rows with the smallest hash, whatever parts they are in."""
    numbers = df.select(*[ref(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    names = numbers.columns
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in names]
    for condition in finite:
        numbers = numbers.filter(condition)
    rows = numbers.orderBy(F.xxhash64(*names), *names).limit(SAMPLE).collect()
    return np.array([tuple(r) for r in rows], np.float64).reshape(-1, len(cols))


def kmeans_joint(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], max_iter: int = 20, seed: int = 42,
    tolerance: float = TOLERANCE,
) -> dict[int, Fit]:
    """One fit for each of ``ks``, all moved by the same readings of the rows.

    A fit is what it would be alone: it starts from its own centres, drawn from a fixed sample
    of ``SAMPLE`` rows, and stops when they have arrived or after ``max_iter`` moves. All rows
    move the centres. A centre without rows stays where it is. Rows with a missing or
    non-finite number take no part; without any row there are no fits.
    """
    sample = _sample(df, cols)
    if not len(sample):
        return {}
    stored = materialize(blocks(df, cols), "point-blocks").persist()
    try:
        moving = {k: first_centers(sample, k, seed) for k in sorted(set(ks))}
        fits: dict[int, Fit] = {}
        for step in range(max_iter + 1):
            # The reading after the last move gives its cost; arrived centres move no more.
            sums = _pass(stored, moving)
            nxt = {}
            for k, c in moving.items():
                n = sums.n[k]
                new = np.where(n[:, None] > 0, sums.total[k] / np.maximum(n, 1)[:, None], c)
                arrived = (((new - c) ** 2).sum(1) <= tolerance**2).all()
                if arrived or step == max_iter:
                    fits[k] = Fit(c, n, sums.cost[k], step)
                else:
                    nxt[k] = new
            moving = nxt
            if not moving:
                break
        return {k: fits[k] for k in ks}
    finally:
        stored.unpersist()


def nearest_number(cols: Sequence[str], centers: np.ndarray) -> Column:
    """Number of the nearest centre, the first on ties, from the columns of a row."""
    squares = [
        sum(((ref(c).cast("double") - F.lit(float(x))) * (ref(c).cast("double") - F.lit(float(x))) for c, x in zip(cols, center)), F.lit(0.0))
        for center in centers
    ]
    away = F.array(*squares)
    return (F.array_position(away, F.array_min(away)) - 1).cast("int")
