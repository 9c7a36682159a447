"""SimHash near-duplicates; fingerprints meet at the anchors of a covering code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts, tagged
from millrace.llm.components import components
from millrace.session import materialize

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Rows of one anchor beyond which its home fingerprints are dealt out over several tasks.
ANCHOR_ROWS = 50_000
PAIRS_AT_ONCE = 1 << 21


def shingle_hashes(raw: bytes, width: int = SHINGLE) -> list[int]:
    """XXH64 of each ``width`` words in a row, A-Z lower-cased, joined by one space."""
    w = raw.lower().split()
    if not w:
        return []
    line = b" ".join(w)
    h = xxhash.xxh64_intdigest
    if len(w) <= width:
        return [h(line, SEED)]
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = np.append(0, ends[:-width]).tolist()
    return [h(line[i:j], SEED) for i, j in zip(starts, (ends[width - 1 :] - 1).tolist())]


def fingerprint(h: np.ndarray) -> np.uint64:
    """Bit i is set if over half the hashes have it; zero without any."""
    if not len(h):
        return np.uint64(0)
    count = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        octets = h[at : at + 4096].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return np.packbits(2 * count > len(h), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``__row``, the key and ``fp`` (bigint): bit i is set if over half the hashes have it."""
    rows = tagged(docs, key, text).toDF("__row", "doc_id", "text")

    def make():
        def work(part, raw):
            fps = np.zeros(len(raw), np.uint64)
            for i, t in enumerate(raw):
                fps[i] = fingerprint(np.array(shingle_hashes(t), np.uint64))
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(fps.view(np.int64))], ["__row", "doc_id", "fp"]
            )

        return work

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, make, f"__row bigint, doc_id {kind}, fp bigint")


# The covering code: the perfect Hamming code of 31 bits, whose words are within distance 1
# of every 31-bit number. Of the low and the high 31 bits of two fingerprints that differ in
# at most 3 bits, one half differs in at most 1; there the anchor next to one fingerprint is
# within covering radius 1 plus 1 of the other.
_BITS = 31


def _syndrome(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), np.int64)
    for i in range(_BITS):
        s ^= ((x >> i) & 1) * (i + 1)
    return s


def anchor_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(cell, fp, home)``: each fingerprint at its nearest anchor (home 1) and at the other
    anchors within distance 2, for the low and the high half."""
    cells, who, homes = [], [], []
    mask = (1 << _BITS) - 1
    for half, x in enumerate((fp & mask, (fp >> 33) & mask)):
        s = _syndrome(x)
        home = np.where(s > 0, x ^ (1 << np.maximum(s - 1, 0)), x)
        cells.append(home | (half << _BITS))
        who.append(fp)
        homes.append(np.ones(len(fp), np.int8))
        for i in range(1, _BITS + 1):
            j = i ^ s
            use = (s > 0) & (j > i)
            near = x[use] ^ (1 << (i - 1)) ^ (1 << (j[use] - 1))
            cells.append(near | (half << _BITS))
            who.append(fp[use])
            homes.append(np.zeros(len(near), np.int8))
    return np.concatenate(cells), np.concatenate(who), np.concatenate(homes)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as ``a - b`` do, at most one for each node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _compare(batches):
    """Links of rows sorted by cell, home rows first; holds the home rows of one cell."""
    held_cell, held = None, np.zeros(0, np.int64)
    for batch in batches:
        cell, part, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
        home = batch.column(3).to_numpy(zero_copy_only=False) == 1
        if not len(cell):
            continue
        cut = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(cell))
        n_home = np.add.reduceat(home.astype(np.int64), starts)
        first = (cell[0], part[0])
        if held_cell == first:
            old = held
        else:
            old = np.zeros(0, np.int64)
        found_a, found_b = [], []

        def look(x, y):
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= THRESHOLD
            near &= x != y
            if near.any():
                a, b = _stars(x[near], y[near])
                found_a.append(a)
                found_b.append(b)

        def cross(homes, members):
            step = max(1, PAIRS_AT_ONCE // max(1, len(members)))
            for at in range(0, len(homes), step):
                h = homes[at : at + step]
                look(np.repeat(h, len(members)), np.tile(members, len(h)))

        if len(old):
            cross(old, fp[: ends[0]])
        sizes = ends - starts
        small = (n_home > 0) & (sizes > 1) & (n_home * sizes <= 4096)
        big = (n_home > 0) & (sizes > 1) & ~small
        if small.any():
            # All (home, member) pairs of the small cells, laid out at once.
            pairs = np.where(small, n_home * sizes, 0)
            ids = np.flatnonzero(small)
            bounds = np.cumsum(pairs[ids])
            at = 0
            while at < len(ids):
                base = bounds[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(bounds, base + PAIRS_AT_ONCE, side="right")))
                g = ids[at:stop]
                m = np.repeat(g, pairs[g])
                k = np.arange(len(m)) - np.repeat(np.cumsum(pairs[g]) - pairs[g], pairs[g])
                look(fp[starts[m] + k // sizes[m]], fp[starts[m] + k % sizes[m]])
                at = stop
        for g in np.flatnonzero(big):
            cross(fp[starts[g] : starts[g] + n_home[g]], fp[starts[g] : ends[g]])
        last = slice(starts[-1], ends[-1])
        tail = fp[last][home[last]]
        held = np.concatenate([old, tail]) if len(starts) == 1 else tail
        held_cell = (cell[-1], part[-1])
        if found_a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"]
            )


def links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``fp`` within the threshold of each other.

    Not every close pair is listed: pairs that meet in one batch are replaced by as many
    links as join the same fingerprints.
    """

    def replicate(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                fp = batch.column(0).slice(at, 20_000).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in anchor_rows(fp)], ["cell", "fp", "home"])

    rows = fps.select("fp").mapInArrow(replicate, "cell bigint, fp bigint, home tinyint")
    hot = materialize(
        rows.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > ANCHOR_ROWS).select(
            "cell", F.ceil(F.col("n") / ANCHOR_ROWS).cast("int").alias("parts")
        ), "hot-anchors",
    )
    cells = rows.select("cell", F.lit(0).alias("part"), "fp", "home")
    if not hot.isEmpty():
        own = F.pmod(F.xxhash64("fp"), "parts").cast("int")
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        wide = rows.join(hot, "cell")
        # A home row of a hot anchor is home in one part, and a member of all parts.
        cells = (
            cells.join(hot, "cell", "left_anti")
            .unionByName(wide.filter("home = 1").select("cell", own.alias("part"), "fp", "home"))
            .unionByName(wide.select("cell", F.explode(every).alias("part"), "fp", F.lit(0).cast("tinyint").alias("home")))
        )
    return (
        cells.repartition("cell", "part")
        .sortWithinPartitions("cell", "part", F.desc("home"))
        .mapInArrow(_compare, "a bigint, b bigint")
    )


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``__row``, key, ``fingerprint`` (16 hex digits), ``component_id``, ``keep_row``.

    Words are parted by blanks, tabs and line ends, A-Z lower-cased; a text of fewer than
    three words is one shingle, one without words or null has fingerprint zero and is
    linked like any other. Fingerprints that differ in at most three bits are linked; the
    component id is the smallest key reached (null only if all its keys are). Equal
    fingerprints, repeated rows included, are one node. ``keep_row`` is the first stored
    row with the smallest key. An empty table gives an empty result. ``docs`` must be a
    stored table.
    """
    rows = materialize(fingerprints(docs, key, text), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("__row").alias("row")))
    nodes = materialize(rows.groupBy("fp").agg(first.alias("best")), "fingerprint-nodes")
    roots = components(links(nodes))
    of = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    best = of.groupBy("root").agg(F.min("best").alias("keep"))
    named = of.join(best, "root").select("fp", "keep")
    return rows.join(named, "fp").select(
        "__row", F.col("doc_id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("keep.doc_id").alias("component_id"), F.col("keep.row").alias("keep_row"),
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``near_copies``, that with the smallest key."""
    row = fresh(docs, "__row")
    gone = near_copies(docs, key, text).filter("__row <> keep_row").select(F.col("__row").alias(row))
    tags = docs.withColumn(row, F.monotonically_increasing_id())
    return tags.join(gone, row, "left_anti").select(*[ref(c) for c in docs.columns])
