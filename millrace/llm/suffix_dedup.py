"""Repeated byte strings by a distributed difference-cover suffix method.

The question is which 200-byte prefixes of suffixes are equal, so suffixes are ranked to
that depth only. Positions whose remainder by ``PERIOD`` lies in a difference cover are
sampled; the tuples of ``TUPLE`` bytes there are named by fingerprints, the names are sorted
and compared with their neighbours. Two equal prefixes share an equal sampled tuple at the
same distance from their starts, as for any two positions the cover holds a shift that takes
both into the sample. A suffix none of whose sampled tuples has an equal is thus done.

The names of a place, of the place one period on and of that two periods on make a triple,
which is named, sorted and compared in turn. Triples overlap and are longer than the depth
by a period, so all prefixes that start in a repeated triple are repeated. What remains are
the ends of long repeats and short repeats: their suffixes are named at full depth, sorted
and compared again, with those of one copy of each repeated triple to meet.

Names are spread over buckets by their leading bits. A slice of texts sends a bucket each of
its names once, in sorted order, and gets back two bits for each: whether another slice has
it too, and whether this slice stands for it. So a passage that a third of all texts share
costs a bucket one name per slice, and no position is ever sent.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import slices
from millrace.session import materialize, scratch_path

DEPTH = 200
#: Singer difference set for the prime power 9: the ten remainders' differences give each
#: non-zero remainder by 91 exactly once.
PERIOD = 91
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
#: Text bytes of a slice, and bytes of text for each bucket of names.
PACK_BYTES = 4 << 20
BUCKET_BYTES = 40 << 20
#: Text bytes that are hashed at once.
STEP = 1 << 18
#: Buckets of the stored slices at most; Spark itself allows 100,000.
MAX_BUCKETS = 50_000

_MUL = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(x, k, 1 << 64))
        k += m
    return out


class Names:
    """Fingerprints of all byte strings of one length: sums over powers of an odd number.

    The sum over a stretch, divided by the power of its start, does not depend on where it
    stands. Bytes are first mapped to random 64-bit numbers, and the result is mixed so
    that its leading bits are even.
    """

    def __init__(self, kind: int, longest: int):
        size = STEP + longest
        x = _MUL[kind] | 1
        self.up = _powers(x, size)
        self.down = _powers(pow(x, -1, 1 << 64), size)
        self.value = np.random.default_rng(kind + 1).integers(1, 1 << 63, 256, dtype=np.uint64)

    def of(self, raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """The names of the strings at the places ``at``, all below ``STEP``."""
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.up[: len(raw)], out=sums[1:])
        return _mixed((sums[at + length] - sums[at]) * self.down[at])


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _tripled(names: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The name of each triple of names, a period apart, that starts at number ``k``."""
    h = names[k].copy()
    for j in (1, 2):
        h = _mixed(h * np.uint64(0x9FB21C651E98DF25) + names[k + j * len(COVER)])
    return h


def _sample(n: int, cover: tuple[int, ...], period: int) -> np.ndarray:
    base = np.arange(0, n, period)
    at = (base[:, None] + np.array(cover)).ravel()
    return at[at < n]


class Slice:
    """Texts laid end to end, and the names taken in them."""

    def __init__(self, sizes, blob: bytes, depth: int, kinds: tuple[Names, Names]):
        self.raw = np.frombuffer(blob, np.uint8)
        self.sizes = np.asarray(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.depth, self.kinds = depth, kinds
        self.tuple = depth - PERIOD + 1

    def sampled(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the cover and the names of the tuples there."""
        at = np.concatenate(
            [s + _sample(n - self.tuple + 1, COVER, PERIOD)
             for s, n in zip(self.starts.tolist(), self.sizes.tolist()) if n >= self.depth]
            or [np.zeros(0, np.int64)]
        )
        return at, self._names(at, self.tuple, self.kinds[0])

    def _names(self, at: np.ndarray, length: int, kind: Names) -> np.ndarray:
        """Names of the strings at sorted places ``at``."""
        out = np.empty(len(at), np.uint64)
        lo = 0
        while lo < len(at):
            first = int(at[lo])
            hi = int(np.searchsorted(at, first + STEP))
            chunk = self.raw[first : int(at[hi - 1]) + length]
            out[lo:hi] = kind.of(chunk, at[lo:hi] - first, length)
            lo = hi
        return out

    def _text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def triples(self, at: np.ndarray, again: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the sampled places where a triple of repeated names starts, and the
        names of these triples, of 64 and 32 bits."""
        step = len(COVER)
        k = np.flatnonzero(again[: -2 * step]) if len(at) > 2 * step else np.zeros(0, np.int64)
        k = k[again[k + step] & again[k + 2 * step]]
        k = k[(at[k + step] - at[k] == PERIOD) & (at[k + 2 * step] - at[k] == 2 * PERIOD)]
        k = k[self._text_of(at[k]) == self._text_of(at[k + 2 * step])]
        out = np.empty(len(k), [("a", "<u8"), ("b", "<u4")])
        out["a"] = _tripled(names, k)
        out["b"] = _tripled(self._names(at, self.tuple, self.kinds[1]), k) >> np.uint64(32)
        return k, out

    def inside(self, at: np.ndarray) -> np.ndarray:
        """Which starts lie in a triple that starts at one of the places."""
        mark = np.zeros(len(self.raw) + 1, np.int32)
        mark[at] += 1
        mark[at + PERIOD + 2] -= 1
        return np.cumsum(mark[:-1]) > 0

    def open_places(self, at: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Starts of whole-depth strings that reach a repeated sampled tuple."""
        n = len(self.raw)
        mark = np.zeros(n + 1, np.int32)
        p = at[again]
        np.add.at(mark, np.maximum(p - (PERIOD - 1), self.starts[self._text_of(p)]), 1)
        mark[p + 1] -= 1
        near = np.cumsum(mark[:-1]) > 0
        # Only starts that leave room for the whole depth.
        edge = np.zeros(n + 1, np.int32)
        long = self.sizes >= self.depth
        np.add.at(edge, self.starts[long], 1)
        np.add.at(edge, (self.starts + self.sizes)[long] - self.depth + 1, -1)
        return np.flatnonzero(near & (np.cumsum(edge[:-1]) > 0))

    def whole(self, places: np.ndarray) -> np.ndarray:
        """Two names, 64 and 32 bits, of the whole-depth strings at ``places``."""
        out = np.empty(len(places), [("a", "<u8"), ("b", "<u4")])
        out["a"] = self._names(places, self.depth, self.kinds[0])
        out["b"] = self._names(places, self.depth, self.kinds[1]) >> np.uint64(32)
        return out


def _order(a: np.ndarray, b: np.ndarray | None = None, kind: str | None = None) -> np.ndarray:
    """An order of the names ``a``, or ``(a, b)``, in which equal ones are neighbours; with the
    kind ``stable`` they stay as they come.

    The 64-bit part alone is sorted, in which few names agree that are not equal; only if some
    do, both parts are.
    """
    order = np.argsort(a, kind=kind)
    if b is not None:
        s, t = a[order], b[order]
        if ((s[1:] == s[:-1]) & (t[1:] != t[:-1])).any():
            return np.lexsort((b, a))
    return order


def _ranked(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names in order, the place of each name among them, and how often each is there."""
    if names.dtype.names is None:
        order = _order(names)
        s = names[order]
        new = s[1:] != s[:-1]
    else:
        order = _order(np.ascontiguousarray(names["a"]), np.ascontiguousarray(names["b"]))
        s = names[order]
        new = (s["a"][1:] != s["a"][:-1]) | (s["b"][1:] != s["b"][:-1])
    first = np.append(True, new) if len(s) else np.zeros(0, bool)
    rank = np.empty(len(s), np.int64)
    rank[order] = np.cumsum(first) - 1
    return s[first], rank, np.bincount(rank, minlength=int(first.sum())) if len(s) else rank


def _bucket_cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    key = distinct if distinct.dtype.names is None else distinct["a"]
    edges = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(key, edges), [len(distinct)]])


def _write(distinct: np.ndarray) -> bytes:
    """Sorted names as bytes; the gaps of 64-bit names need few leading bytes."""
    a = distinct if distinct.dtype.names is None else distinct["a"]
    gaps = np.diff(a, prepend=a[:1])
    planes = gaps.view(np.uint8).reshape(-1, 8)
    used = int(np.flatnonzero(planes.any(0))[-1]) + 1 if planes.any() else 1
    rest = b"" if distinct.dtype.names is None else np.ascontiguousarray(distinct["b"]).tobytes()
    head = bytes([used]) + a[:1].tobytes()
    return head + np.ascontiguousarray(planes[:, :used].T).tobytes() + rest


def _read(raw: bytes, n: int, pairs: bool) -> tuple[np.ndarray, np.ndarray | None]:
    used = raw[0]
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = np.frombuffer(raw, np.uint8, n * used, 9).reshape(used, n).T
    a = np.cumsum(planes.reshape(-1).view(np.uint64), dtype=np.uint64)
    a += np.frombuffer(raw, np.uint64, 1, 1)
    return a, np.frombuffer(raw, np.uint32, n, 9 + n * used) if pairs else None


def pack(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Slices of whole texts: ``slice``, ``ids``, ``sizes``, ``blob``; null counts as empty."""
    rows = docs.select(ref(key).cast("bigint").alias("id"), ref(text).alias("text"))

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, raw in slices(batch, "text", PACK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([[len(t) for t in raw]], pa.list_(pa.int64())),
                        pa.array([b"".join(raw)], pa.binary()),
                    ],
                    ["slice", "ids", "sizes", "blob"],
                )
                number += 1

    return rows.mapInArrow(run, "slice bigint, ids array<bigint>, sizes array<bigint>, blob binary")


def _sent(number: int, names: np.ndarray, buckets: int):
    """One row for each bucket that some of the names fall into."""
    distinct, _, _ = _ranked(names)
    cuts = _bucket_cuts(distinct, buckets)
    full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
    if full:
        parts = [distinct[cuts[b] : cuts[b + 1]] for b in full]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()), pa.array([number] * len(full), pa.int64()),
                pa.array(list(map(len, parts)), pa.int64()), pa.array(list(map(_write, parts)), pa.binary()),
            ],
            ["bucket", "slice", "n", "names"],
        )


_SENT = "bucket int, slice bigint, n bigint, names binary"


def _shared(sent: DataFrame, pairs: bool) -> DataFrame:
    """For each slice the bits of its names, bucket by bucket: has another slice the name,
    and does this slice stand for it (the first of the bucket that has it)?"""

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        sizes = group["n"].to_numpy()
        read = [_read(bytes(r), int(n), pairs) for r, n in zip(group["names"], sizes)]
        a = np.concatenate([x for x, _ in read])
        if pairs:
            b = np.concatenate([y for _, y in read])
            # Stable: one slice is to stand for all names of a passage, or more places stay open.
            order = _order(a, b, "stable")
            same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        else:
            order = _order(a, kind="stable")
            same = a[order][1:] == a[order][:-1]
        twice, first = np.zeros(len(a), bool), np.ones(len(a), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        first[order[1:][same]] = False
        ends = np.cumsum(sizes)
        bits, own = ([np.packbits(x[e - n : e]).tobytes() for e, n in zip(ends, sizes)] for x in (twice, first))
        return pd.DataFrame({"slice": group["slice"], "bucket": group["bucket"], "n": sizes, "bits": bits, "own": own})

    met = sent.groupBy("bucket").applyInPandas(meet, "slice bigint, bucket int, n bigint, bits binary, own binary")
    # A slice has a bounded number of names, so its bits are few.
    parts = F.collect_list(F.struct("bucket", "n", "bits", "own"))
    return met.groupBy("slice").agg(F.sort_array(parts).alias("flags"))


def _flags(parts, name: str) -> np.ndarray:
    if not parts:
        return np.zeros(0, bool)
    return np.concatenate(
        [np.unpackbits(np.frombuffer(p[name], np.uint8), count=p["n"]).astype(bool) for p in parts]
    )


def _again(names: np.ndarray, parts) -> tuple[np.ndarray, np.ndarray]:
    """Which of the names stand twice in this slice or in another one as well, and for which
    of all names this slice stands."""
    distinct, rank, count = _ranked(names)
    if not len(distinct):
        return np.zeros(0, bool), np.zeros(0, bool)
    return (_flags(parts, "bits") | (count > 1))[rank], _flags(parts, "own")[rank]


def _stored(packed: DataFrame) -> DataFrame:
    """The slices as a table bucketed by slice, so that joins with their flags move no text."""
    spark, path = packed.sparkSession, scratch_path(packed.sparkSession, "slices")
    name = "slices_" + path[-32:]
    parts = min(max(1, packed.rdd.getNumPartitions()), MAX_BUCKETS)
    packed.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(
        parts, "slice"
    ).saveAsTable(name)
    return spark.table(name)


def removed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, keep: bool = True
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if ``keep``,
    ``kept``, the remaining bytes (they may cut a character).

    A byte is removed when it lies in a string of ``depth`` bytes of its text that starts
    anywhere else too, in another text or in the same; repeated rows therefore remove each
    other. Strings are judged on the given texts, and are equal when 96 bits of fingerprint
    are. Null texts count as empty; texts under ``depth`` bytes lose nothing. An empty table
    gives an empty result. Keys are whole numbers, null allowed; other columns are not
    looked at. ``depth`` must be over twice the cover's period.
    """
    if depth <= 2 * PERIOD:
        raise ValueError(f"depth must be over {2 * PERIOD}")
    packed = _stored(pack(docs, key, text))
    total = packed.agg(F.sum(F.octet_length("blob"))).first()[0] or 0
    buckets = max(8, math.ceil(total / BUCKET_BYTES))

    def kinds():
        return Names(0, depth), Names(1, depth)

    def rows_of(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}

    def first(batches):
        named = kinds()
        for r in rows_of(batches):
            part = Slice(r["sizes"], r["blob"], depth, named)
            yield from _sent(r["slice"], part.sampled()[1], buckets)

    def repeated_tuples(r, named):
        part = Slice(r["sizes"], r["blob"], depth, named)
        at, names = part.sampled()
        again, _ = _again(names, r["flags"])
        return part, at, again, *part.triples(at, again, names)

    def remaining(r, named):
        """Starts known to be repeated, and the places and names that are still compared:
        starts outside repeated triples, and those in triples this slice stands for."""
        part, at, again, k, triples = repeated_tuples(r, named)
        twice, own = _again(triples, r["triples"])
        known = part.inside(at[k[twice]])
        places = part.open_places(at, again)
        places = places[~known[places] | part.inside(at[k[twice & own]])[places]]
        return part, np.flatnonzero(known), places, part.whole(places)

    def second(batches):
        named = kinds()
        for r in rows_of(batches):
            yield from _sent(r["slice"], repeated_tuples(r, named)[4], buckets)

    def third(batches):
        named = kinds()
        for r in rows_of(batches):
            yield from _sent(r["slice"], remaining(r, named)[3], buckets)

    def last(batches):
        named = kinds()
        for r in rows_of(batches):
            part, known, places, names = remaining(r, named)
            starts = np.union1d(known, places[_again(names, r["whole"])[0]])
            mark = np.zeros(len(part.raw) + 1, np.int32)
            mark[starts] += 1
            mark[starts + depth] -= 1
            gone = np.cumsum(mark[:-1]) > 0
            out = []
            for i, s, n in zip(r["ids"], part.starts.tolist(), part.sizes.tolist()):
                g = gone[s : s + n]
                kept = part.raw[s : s + n][~g].tobytes()
                runs = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
                row = (i, n, int(g.sum()), runs, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if keep else row)
            if out:
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(arrays, fields)

    fields = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if keep else 5]
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def answered(name: str, asked: DataFrame, work, pairs: bool) -> DataFrame:
        """``asked`` with the answers to what ``work`` sends about its slices."""
        sent = asked.drop("ids").mapInArrow(work, _SENT)
        found = materialize(_shared(sent, pairs).withColumnRenamed("flags", name), "flags")
        return asked.join(found.hint("shuffle_hash"), "slice", "left")

    tuples = answered("flags", packed, first, False)
    triples = answered("triples", tuples, second, True)
    whole = answered("whole", triples, third, True)
    out = whole.mapInArrow(last, schema + ", kept binary" * keep)
    return out.withColumnRenamed("id", key)
