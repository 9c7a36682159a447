"""Near copies by the Jaccard similarity of word shingles: SimHash and MinHash bands, then exact sets.

Texts whose SimHash fingerprints are joined by differences of at most three bits, and texts of
which one band of least hashes agrees, are candidates. Every candidate pair of a band is either
compared by its whole shingle sets or already joined by pairs that were.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm import simhash
from millrace.llm.batches import fresh, map_texts, tagged
from millrace.llm.components import components
from millrace.llm.simhash import fingerprint, shingle_hashes
from millrace.session import materialize

WIDTH = 5
SIMILARITY = 0.8
#: A pair of similarity s shares no band with probability (1 - s ** ROWS) ** BANDS, which is
#: below 7e-6 at 0.8.
BANDS, ROWS = 30, 5
#: Texts that one task compares with the same text.
MEMBERS = 2_000
#: Bands by which a text finds the one that it is compared with first.
STAR_BANDS = 6
#: Texts that one task holds to compare others with.
HOMES = 256

_DRAWN = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_MULTIPLIERS, _OFFSETS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def shingle_set(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Different shingle hashes of a text, sorted."""
    return np.unique(np.array(shingle_hashes(raw, width), np.uint64))


def bands(shingles: np.ndarray) -> list[int]:
    """One hash for each band of least hashes; none for a text without words."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(shingles), 1024):
        x = shingles[at : at + 1024, None] * _MULTIPLIERS + _OFFSETS
        # The low bits of a product are weak.
        least = np.minimum(least, ((x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).min(0))
    return [
        xxhash.xxh3_64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), seed=k) - (1 << 63) for k in range(BANDS)
    ]


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sets of hashes have at least the Jaccard similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def signatures(rows: DataFrame, width: int) -> DataFrame:
    """``__row``, ``doc_id``, ``fp`` (the same for equal shingle sets), ``size``, ``bands`` and
    ``print``, the SimHash fingerprint of the set."""

    def make():
        def work(part, raw):
            sets = [shingle_set(t, width) for t in raw]
            fps = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(fps, pa.int64()), pa.array(map(len, sets), pa.int32()),
                 pa.array(map(bands, sets), pa.list_(pa.int64())),
                 pa.array(np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64))],
                ["__row", "doc_id", "fp", "size", "bands", "print"],
            )

        return work

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, make, f"__row bigint, doc_id {kind}, fp bigint, size int, bands array<bigint>, print bigint")


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those pairs ``(a, b)`` whose texts, ``(fp, text)`` once each, are similar.

    The text of ``a`` is sent once for each ``MEMBERS`` texts it is compared with.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("b"), "parts").cast("int")
    members = pairs.join(parts, "a").select("a", own.alias("part"), "b")
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"))
    laid = members.unionByName(heads).join(texts, F.col("b") == F.col("fp")).select("a", "part", "b", "text")

    def compare(batches):
        head, held = None, None
        for batch in batches:
            found_a, found_b = [], []
            for i in range(batch.num_rows):
                a, b = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                s = shingle_set((batch.column(3)[i].as_py() or "").encode(), width)
                if a == b:
                    head, held = a, s
                elif a != head:
                    raise ValueError("a text to compare with is missing")
                elif similar(held, s, similarity):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    ordered = laid.repartition("a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"))
    return ordered.mapInArrow(compare, "a bigint, b bigint")


class Homes:
    """Shingle sets of the home texts of a part, looked up by shingle."""

    def __init__(self, similarity: float):
        self.similarity, self.fps, self.roots, self.sets = similarity, [], [], []

    def add(self, fp: int, root: int, s: np.ndarray) -> None:
        self.fps.append(fp)
        self.roots.append(root)
        self.sets.append(s)

    def close(self) -> None:
        """No home comes any more: sort all shingles with the homes that have them."""
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.shingles, self.owner = every[order], owner[order]
        self.root = np.array(self.roots, np.int64)
        self.joined = np.arange(len(self.sets))

    def _low(self, i: int) -> int:
        while self.joined[i] != i:
            self.joined[i] = self.joined[self.joined[i]]
            i = self.joined[i]
        return i

    def similar_to(self, fp: int, root: int, s: np.ndarray) -> list[int]:
        """Homes of other components that are similar to a text, but for those that links
        given before join to one of them."""
        start, stop = np.searchsorted(self.shingles, s, "left"), np.searchsorted(self.shingles, s, "right")
        n = stop - start
        # All places of all of the text's shingles, one stretch after the other.
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.sets))
        near = np.flatnonzero((both >= self.similarity * (self.sizes + len(s) - both)) & (self.root != root))
        out: list[int] = []
        for i in near.tolist():
            low = self._low(i)
            if not out:
                first = low
            elif low == self._low(first):
                continue
            else:
                self.joined[low] = self._low(first)
            out.append(self.fps[i])
        return out


def compared(laid: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links ``(a, b)`` of each part: its home texts against all its texts, of rows
    ``(part, home, fp, root, text)``. No two texts of one component are compared, and of links
    that join the same texts only as many as texts are given."""

    def run(batches):
        part, homes, closed = None, None, False
        found_a, found_b = [], []

        def ask(fp, root, s):
            for a in homes.similar_to(fp, root, s):
                found_a.append(a)
                found_b.append(fp)

        def close():
            homes.close()
            for fp, root, s in zip(homes.fps, homes.roots, homes.sets):
                ask(fp, root, s)

        for batch in batches:
            for i in range(batch.num_rows):
                p, home, fp, root = (batch.column(c)[i].as_py() for c in range(4))
                if p != part:
                    if homes is not None and not closed:
                        close()
                    part, homes, closed = p, Homes(similarity), False
                s = shingle_set((batch.column(4)[i].as_py() or "").encode(), width)
                if home:
                    homes.add(fp, root, s)
                    continue
                if not closed:
                    close()
                    closed = True
                ask(fp, root, s)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])
            found_a.clear()
            found_b.clear()
        if homes is not None and not closed:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    rows = laid.select("part", "home", "fp", "root", "text")
    ordered = rows.repartition("part").sortWithinPartitions("part", F.desc("home"))
    return ordered.mapInArrow(run, "a bigint, b bigint")


def _between_components(of: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links between texts of one band and different components, ``of`` is ``(fp, root, band)``.

    The largest component of a band is left as it is; every other text of the band is a home.
    Homes are dealt into parts of about ``HOMES`` by the largest band that they are in, so homes
    that share bands are together; a part gets all texts that share a band with one of its
    homes, each once, and compares them all.
    """
    sizes = of.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), F.sum("n").alias("n")
    )
    several = materialize(main.filter("roots > 1").select("band", "main", "n"), "mixed-bands")
    mixed = materialize(of.join(several, "band"), "mixed-texts")
    few = materialize(
        mixed.filter("root <> main").groupBy("fp").agg(F.max(F.struct("n", "band")).alias("most")).select("fp", "most.band"), "homes"
    )
    n_parts = max(1, -(-few.count() // HOMES))
    cuts = few.groupBy("band").agg(F.ceil(F.count("*") / HOMES).cast("int").alias("cuts"))
    cut = F.pmod(F.xxhash64("fp"), "cuts")
    homes = materialize(few.join(cuts, "band").select("fp", F.pmod(F.xxhash64("band", cut), F.lit(n_parts)).alias("part")), "dealt-homes")
    # The parts of a band are one list, so a text has one row for each of its bands, then one list.
    reach = mixed.filter("root <> main").join(homes, "fp").groupBy("band").agg(F.collect_set("part").alias("parts"))
    met = mixed.join(reach, "band").groupBy("fp", "root").agg(F.array_distinct(F.flatten(F.collect_set("parts"))).alias("parts"))
    routed = met.select(F.explode("parts").alias("part"), "fp", "root")
    marked = routed.join(homes.withColumn("home", F.lit(True)), ["part", "fp"], "left")
    laid = marked.select("part", F.coalesce("home", F.lit(False)).alias("home"), "fp", "root").join(texts, "fp")
    return compared(laid, width, similarity)


def _by_fingerprint(nodes: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: each text ``b`` beside the first text of its component of fingerprints, which
    meet at the anchors of ``simhash``; pairs that their sizes rule out are left out."""
    first = F.min(F.struct("fp", "size"))
    prints = materialize(nodes.groupBy("print").agg(first.alias("head")), "prints")
    roots = components(simhash.links(prints.select(F.col("print").alias("fp"))))
    of = prints.join(roots, prints["print"] == roots["node"], "left").select(
        "print", "head", F.coalesce("root", "print").alias("root")
    )
    heads = of.groupBy("root").agg(F.min("head").alias("head"))
    met = nodes.join(of.select("print", "root"), "print").join(heads, "root")
    fits = F.least("size", "head.size") >= similarity * F.greatest("size", "head.size")
    return met.filter((F.col("fp") != F.col("head.fp")) & fits).select(F.col("head.fp").alias("a"), F.col("fp").alias("b"))


def links(nodes: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links that connect all candidates that are similar.

    Every text is first compared with at most two others: the first text of its component of
    SimHash fingerprints, and the first text among those it shares one of
    the first ``STAR_BANDS`` bands with; that joins most near copies. Texts that share any band
    and are still in different components are then compared one by one inside tasks; only links
    leave a task, never pairs that are not similar. Bands of one component need no more work, so
    their texts are only counted.
    """
    cells = nodes.select("fp", "size", F.explode(F.slice("bands", 1, STAR_BANDS)).alias("band"))
    shared = cells.groupBy("band").agg(
        F.min(F.struct("fp", "size")).alias("head"), F.count("*").alias("n")
    ).filter("n > 1").select("band", F.col("head.fp").alias("a"), F.col("head.size").alias("head_size"))
    fits = F.least("size", "head_size") >= similarity * F.greatest("size", "head_size")
    met = cells.join(shared, "band").filter((F.col("fp") != F.col("a")) & fits)
    tried = met.groupBy(F.col("fp").alias("b")).agg(F.min("a").alias("a"))
    pairs = materialize(_by_fingerprint(nodes, similarity).unionByName(tried.select("a", "b")).distinct(), "tried")
    first = materialize(verified(pairs, texts, width, similarity), "similar")
    roots = components(first)
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "bands")
    of = materialize(rooted.select("fp", "root", F.explode("bands").alias("band")), "band-members")
    second = _between_components(of, texts, width, similarity)
    return first.unionByName(materialize(second, "similar"))


def similar_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY
) -> DataFrame:
    """Per row: ``__row``, key, ``component_id`` and ``keep_row``, as in ``simhash.near_copies``.

    Texts are linked whose sets of ``width``-word shingles have a Jaccard similarity of at
    least ``similarity``; equal sets, repeated rows and texts without words included, are one
    node. Words are those of ``simhash.near_copies``; a text of fewer words is one shingle.
    An empty table gives an empty result. ``docs`` must be a stored table.
    """
    rows = tagged(docs, key, text).toDF("__row", "doc_id", "text")
    signed = materialize(signatures(rows, width), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("__row").alias("row")))
    nodes = materialize(
        signed.groupBy("fp").agg(first.alias("best"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("print").alias("print")),
        "signature-nodes",
    )
    texts = rows.join(nodes.select("fp", F.col("best.row").alias("__row")), "__row").select("fp", "text")
    roots = components(links(nodes, texts, width, similarity))
    of = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    best = of.groupBy("root").agg(F.min("best").alias("keep"))
    named = of.join(best, "root").select("fp", "keep")
    return signed.select("__row", "doc_id", "fp").join(named, "fp").select(
        "__row", F.col("doc_id").alias(key),
        F.col("keep.doc_id").alias("component_id"), F.col("keep.row").alias("keep_row"),
    )


def drop_similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one row of each component of ``similar_copies``, that with the smallest key."""
    row = fresh(docs, "__row")
    gone = similar_copies(docs, key, text, width, similarity).filter("__row <> keep_row").select(F.col("__row").alias(row))
    tags = docs.withColumn(row, F.monotonically_increasing_id())
    return tags.join(gone, row, "left_anti").select(*[ref(c) for c in docs.columns])
