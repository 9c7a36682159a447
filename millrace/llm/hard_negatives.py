"""Hard negatives of anchor vectors, scored by the method of the Four Russians.

Components are whole numbers. Of an anchor, every group of eight dimensions gets a table with
the sum of each of its 256 subsets. A candidate's components are cut into bit planes: the bits
of one weight of eight dimensions are a byte. The inner product is the sum, over planes and
groups, of the table's entry at that byte times the weight of the plane: all look-ups, shifts
and additions, and exact.

Anchors come in blocks of bounded size to all candidates, which stay where they are. A task
keeps, for each anchor and band of scores, only the best candidates it has met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize, scratch_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Bytes of anchors that go to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Candidates held by a task, anchors whose tables it builds, and candidates scored at once.
HELD, TABLES, CHUNK = 16_384, 256, 1_024
#: Whole numbers are held to this size; scores are exact while they fit into 63 bits.
LARGEST = 1 << 30

_LEAST = np.iinfo(np.int64).min


def whole_numbers(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row``, ``id``, ``label`` and ``v``: ``floor(scale * x)`` of each component as packed
    32-bit numbers; vectors with a null or non-finite component are left out."""

    def run(batches):
        for batch in batches:
            column = batch.column(3)
            flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
            ends = np.cumsum(np.where(column.is_valid(), column.value_lengths().fill_null(0), 0))
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            starts = np.append(0, ends[:-1]) if len(ends) else ends
            good = (bad[ends] == bad[starts]) & np.asarray(column.is_valid())
            whole = np.clip(np.floor(scale * np.where(np.isfinite(flat), flat, 0)), -LARGEST, LARGEST).astype("<i4")
            packed = whole.tobytes()
            use = np.flatnonzero(good)
            values = [packed[4 * a : 4 * b] for a, b in zip(starts[use].tolist(), ends[use].tolist())]
            keep = pa.array(use)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(keep) for i in range(3)] + [pa.array(values, pa.binary())],
                ["row", "id", "label", "v"],
            )

    return rows.mapInArrow(run, "row bigint, id bigint, label bigint, v binary")


def unpacked(values: list[bytes], dims: int) -> np.ndarray:
    """Packed vectors as one matrix, missing components as zeros."""
    if all(len(v) == 4 * dims for v in values):
        return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dims)
    return np.frombuffer(b"".join(v[: 4 * dims].ljust(4 * dims, b"\0") for v in values), "<i4").reshape(len(values), dims)


def bit_planes(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """``(planes, least)``: bytes ``[plane, group, vector]`` of the components less ``least``."""
    least = int(vectors.min(initial=0))
    shifted = vectors.astype(np.int64) - least
    planes = int(shifted.max(initial=0)).bit_length()
    bits = np.zeros((planes, len(vectors), -(-vectors.shape[1] // 8) * 8), np.uint8)
    for b in range(planes):
        bits[b, :, : vectors.shape[1]] = (shifted >> b) & 1
    return np.ascontiguousarray(np.packbits(bits, axis=2, bitorder="little").transpose(0, 2, 1)), least


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """``[group, subset, anchor]``: the sum of every subset of eight components in a row."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, n), kind)
    padded[:dims] = anchors.T
    tables = np.zeros((groups, 256, n), kind)
    for k in range(8):
        # Each further dimension doubles the subsets: those without it, and those with it.
        tables[:, 1 << k : 2 << k] = tables[:, : 1 << k] + padded[k::8][:, None]
    return tables


def score_type(anchors: np.ndarray, planes: int) -> type:
    """A number type that holds every partial sum."""
    most = int(np.abs(anchors.astype(np.int64)).max(initial=0)) * anchors.shape[1] << planes
    return np.int32 if most < 1 << 31 else np.int64


def scores(tables: np.ndarray, sums: np.ndarray, planes: np.ndarray, least: int, at: slice) -> np.ndarray:
    """Inner products ``[candidate, anchor]`` of the candidates ``at`` with the tables' anchors."""
    some = planes[:, :, at]
    out = np.zeros((some.shape[2], tables.shape[2]), tables.dtype)
    met = np.empty_like(out)
    for plane in some[::-1]:
        out <<= 1
        for group, subsets in enumerate(plane):
            np.take(tables[group], subsets, axis=0, out=met, mode="clip")
            out += met
    return out.astype(np.int64) + least * sums


class Best:
    """The ``k`` best candidates of each (anchor, band): highest score, then smallest id, then row."""

    def __init__(self, anchors: int, bands: int, k: int):
        self.score = np.full((anchors, bands, k), _LEAST)
        self.id = np.zeros((anchors, bands, k), np.int64)
        self.row = np.zeros((anchors, bands, k), np.int64)

    def add(self, band: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        last = self.score[anchor, band, -1]
        # Of a score that is full already only smaller ids can enter.
        use = (score > last) | ((score == last) & (ids <= self.id[anchor, band, -1]))
        if not use.any():
            return
        anchor, score, ids, rows = anchor[use], score[use], ids[use], rows[use]
        touched, k = np.unique(anchor), self.score.shape[2]
        a = np.concatenate([np.repeat(touched, k), anchor])
        s = np.concatenate([self.score[touched, band].ravel(), score])
        i = np.concatenate([self.id[touched, band].ravel(), ids])
        r = np.concatenate([self.row[touched, band].ravel(), rows])
        order = np.lexsort((r, i, ~s, a))
        a, s, i, r = a[order], s[order], i[order], r[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        use = rank < k
        to = (a[use], band, rank[use])
        self.score[to], self.id[to], self.row[to] = s[use], i[use], r[use]


class Block:
    """Anchors of one block: row, id, label, vectors, and the bands of scores wanted of each."""

    def __init__(self, found: pa.Table, dims: int, same: bool):
        self.row = found.column("row").to_numpy()
        self.label = found.column("label").to_numpy()
        self.vectors = unpacked(found.column("v").to_pylist(), dims)
        self.same = same
        if same:
            self.low, self.high = np.full((len(self.row), 1), _LEAST + 1), np.full((len(self.row), 1), -_LEAST - 1)
        else:
            # A missing positive is a band that holds nothing.
            wanted = found.column("bands").to_pylist()
            width = max((len(b) for b in wanted), default=0)
            self.low = np.array([[x["low"] for x in b] + [1] * (width - len(b)) for b in wanted], np.int64).reshape(len(wanted), width)
            self.high = np.array([[x["high"] for x in b] + [0] * (width - len(b)) for b in wanted], np.int64).reshape(len(wanted), width)

    def search(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, best: Best) -> None:
        """Compare held candidates with all anchors; those of one label in a row."""
        order = np.argsort(labels, kind="stable")
        ids, rows, labels, vectors = ids[order], rows[order], labels[order], vectors[order]
        planes, least = bit_planes(vectors)
        for at in range(0, len(self.row), TABLES):
            some = self.vectors[at : at + TABLES]
            kind = score_type(some, len(planes))
            tables, sums = subset_sums(some, kind), some.astype(np.int64).sum(1)
            if self.same:
                # Only anchors of the candidates' own label are scored.
                for label in np.unique(self.label[at : at + TABLES]):
                    mine = np.flatnonzero(self.label[at : at + TABLES] == label)
                    start, stop = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
                    own = np.ascontiguousarray(tables[:, :, mine])
                    for c in range(start, stop, CHUNK):
                        part = slice(c, min(c + CHUNK, stop))
                        found = scores(own, sums[mine], planes, least, part)
                        self._collect(best, found, at + mine, part, ids, rows, labels)
            else:
                for c in range(0, len(ids), CHUNK):
                    part = slice(c, min(c + CHUNK, len(ids)))
                    found = scores(tables, sums, planes, least, part)
                    self._collect(best, found, at + np.arange(len(some)), part, ids, rows, labels)

    def _collect(self, best, found, anchors, part, ids, rows, labels) -> None:
        other = None if self.same else labels[part, None] != self.label[anchors]
        for band in range(self.low.shape[1]):
            floor = np.maximum(self.low[anchors, band], best.score[anchors, band, -1])
            use = (found >= floor) & (found <= self.high[anchors, band])
            use &= rows[part, None] != self.row[anchors] if self.same else other
            c, a = np.nonzero(use)
            if len(c):
                best.add(band, anchors[a], found[c, a], ids[part][c], rows[part][c])


def best_of_block(candidates: DataFrame, block: Block, dims: int, k: int) -> DataFrame:
    """``(anchor, band, score, id, row)``: of each task the best ``k`` for each anchor and band."""

    def run(batches):
        best = Best(len(block.row), block.low.shape[1], k)
        for ids, rows, labels, values in _held(batches):
            block.search(ids, rows, labels, unpacked(values, dims), best)
        anchor, band, rank = np.nonzero(best.score > _LEAST)
        for at in range(0, len(anchor), 100_000):
            p = (anchor[at : at + 100_000], band[at : at + 100_000], rank[at : at + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.row[p[0]]), pa.array(p[1].astype(np.int32)), pa.array(best.score[p]),
                 pa.array(best.id[p]), pa.array(best.row[p])],
                ["anchor", "band", "score", "id", "row"],
            )

    return candidates.select("row", "id", "label", "v").mapInArrow(
        run, "anchor bigint, band int, score bigint, id bigint, row bigint"
    )


def _held(batches) -> Iterator[tuple]:
    """Candidates of several batches together, ``HELD`` at most."""
    pending, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, HELD):
            part = batch.slice(at, HELD)
            if n + part.num_rows > HELD and pending:
                yield _joined(pending)
                pending, n = [], 0
            pending.append(part)
            n += part.num_rows
    if n:
        yield _joined(pending)


def _joined(parts: list) -> tuple:
    whole = pa.Table.from_batches(parts)
    number = lambda c: whole.column(c).to_numpy()
    return number("id"), number("row"), number("label"), whole.column("v").to_pylist()


def _searched(anchors: DataFrame, candidates: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` candidates for each anchor and band over all tasks, with ``rank`` from 1.

    Blocks of anchors are fetched one at a time; what a block finds is stored before the next.
    """
    spark = anchors.sparkSession
    blocks = max(1, math.ceil(2 * anchors.count() * (4 * dims + 200) / BLOCK_BYTES))
    path = scratch_path(spark, "anchor-blocks")
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    spread = F.pmod(F.hash("row"), F.lit(8))
    dealt.repartition("block", spread).write.partitionBy("block").parquet(path)
    out = scratch_path(spark, "block-best")
    for number in range(blocks):
        part = spark.read.schema(dealt.schema).parquet(path).filter(F.col("block") == number)
        block = Block(part.drop("block").toArrow(), dims, same)
        best_of_block(candidates, block, dims, k).write.mode("append").parquet(out)
    schema = "anchor bigint, band int, score bigint, id bigint, row bigint"
    by = W.partitionBy("anchor", "band").orderBy(F.desc("score"), "id", "row")
    return spark.read.schema(schema).parquet(out).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchor, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """Per anchor, positive and hard negative: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` is a condition on the key. A component x counts as ``floor(256 * x)``; scores
    are exact inner products, higher ones come first, ties by the smaller key, then by the
    stored row. An anchor's positives are its best ``positives`` other rows of the same label;
    a positive's negatives are the best ``negatives`` rows of other labels whose score lies
    between ``LOW`` and ``HIGH`` hundredths of the positive's, both included. All candidates
    are scored, nothing is capped or sampled.

    Rows with a null key, label or vector, or a null or non-finite component take no part.
    Vectors of different lengths are compared as if zeros followed the shorter one; an empty
    vector scores 0. Repeated rows are rows of their own. Whole numbers beyond 2 ** 30 are
    held to it. An empty table, or one without anchors, gives an empty result. ``vectors``
    must be a stored table; its other columns are not looked at.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), ref(key).cast("bigint").alias("id"),
        ref(label).cast("bigint").alias("label"), ref(vector).alias("v"),
    ).filter("id is not null and label is not null and v is not null")
    ready = materialize(whole_numbers(rows), "whole-vectors")
    dims = max(1, (ready.agg(F.max(F.octet_length("v"))).first()[0] or 0) // 4)
    anchors = ready.filter(anchor(F.col("id")))
    first = materialize(_searched(anchors, ready, dims, positives, True), "positives")
    of_anchor = first.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found")
    )
    # LOW p <= 100 s <= HIGH p in whole numbers; div cuts towards zero, pmod makes it exact before.
    down = lambda x: f"(({x}) - pmod({x}, 100L)) div 100"
    bands = F.expr(
        f"transform(found, p -> struct(-({down(f'{-LOW} * p.score')}) AS low, {down(f'{HIGH} * p.score')} AS high))"
    )
    wanted = anchors.join(of_anchor, anchors["row"] == of_anchor["anchor"]).select(
        "row", "id", "label", "v", bands.alias("bands")
    )
    second = _searched(wanted, ready, dims, negatives, False)
    pairs = first.select(
        "anchor", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return second.join(pairs, ["anchor", "band"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )

