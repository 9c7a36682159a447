"""Exact deduplication with a cuckoo-filter index over digests of normalised texts."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts, tagged
from millrace.session import materialize

SLOTS = 4
MAX_KICKS = 200
NO_ID = (1 << 63) - 1


class CuckooIndex:
    """Live digests with the best row of each: a cuckoo filter before bucketed content.

    The filter holds a 16-bit mark of a digest in one of its two buckets, so a lookup
    that finds no mark proves the digest is new. A mark that is found is checked against
    the whole digests stored under the home bucket. When an insertion moves ``MAX_KICKS``
    marks without finding a free slot, the filter is doubled and filled again from the
    stored digests.
    """

    def __init__(self, buckets: int = 1024):
        self.size = 0
        self.moves = random.Random(7)
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks: list[list[int]] = [[] for _ in range(buckets)]
        self.content: list[list[list]] = [[] for _ in range(buckets)]

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        home = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, home, self._other(home, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def find(self, digest: bytes) -> list | None:
        """The entry ``[digest, id, row, count]``, or None."""
        mark, home, other = self._place(digest)
        if mark not in self.marks[home] and mark not in self.marks[other]:
            return None
        for entry in self.content[home]:
            if entry[0] == digest:
                return entry
        return None

    def insert(self, digest: bytes, doc_id: int, row: int, count: int = 1) -> None:
        """Add ``count`` rows; the smallest ``(doc_id, row)`` becomes the entry's."""
        entry = self.find(digest)
        if entry is not None:
            if (doc_id, row) < (entry[1], entry[2]):
                entry[1], entry[2] = doc_id, row
            entry[3] += count
            return
        self._add([digest, doc_id, row, count])

    def delete(self, digest: bytes) -> bool:
        """Remove a digest with all its rows; False when it is not there."""
        entry = self.find(digest)
        if entry is None:
            return False
        mark, home, other = self._place(digest)
        self.content[home].remove(entry)
        self.marks[home if mark in self.marks[home] else other].remove(mark)
        self.size -= 1
        return True

    def _add(self, entry: list) -> None:
        mark, home, other = self._place(entry[0])
        self.content[home].append(entry)
        self.size += 1
        for bucket in (home, other):
            if len(self.marks[bucket]) < SLOTS:
                self.marks[bucket].append(mark)
                return
        bucket = other
        for _ in range(MAX_KICKS):
            slot = self.moves.randrange(SLOTS)
            mark, self.marks[bucket][slot] = self.marks[bucket][slot], mark
            bucket = self._other(bucket, mark)
            if len(self.marks[bucket]) < SLOTS:
                self.marks[bucket].append(mark)
                return
        self._resize()

    def _resize(self) -> None:
        kept = list(self.entries())
        self.size = 0
        self._clear(2 * (self.mask + 1))
        for entry in kept:
            self._add(entry)

    def entries(self):
        for bucket in self.content:
            yield from bucket


def normalise(raw: bytes) -> bytes:
    """Each run of blanks, tabs, line ends, vertical tabs and form feeds made one space."""
    body = b" ".join(raw.split())
    if not body:
        return b" " if raw else b""
    return (b" " if raw[:1].isspace() else b"") + body + (b" " if raw[-1:].isspace() else b"")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``__row``, the key and ``digest``, the SHA-256 of the normalised text, per row."""
    narrow = tagged(docs, key, text).toDF("__row", "doc_id", "text")

    def make():
        def work(part, raw):
            done = pa.array([hashlib.sha256(normalise(t)).digest() for t in raw], pa.binary())
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), done], ["__row", "doc_id", "digest"]
            )

        return work

    return map_texts(
        narrow.withColumn("doc_id", F.col("doc_id").cast("bigint")),
        make, "__row bigint, doc_id bigint, digest binary",
    )


def copy_groups(rows: DataFrame) -> DataFrame:
    """One row per digest of ``digests``: ``keep_id``, ``keep_row`` and ``group_size``.

    Each task first folds its own rows with an index, so a digest leaves a task once,
    however many copies there are; the folded rows meet by digest and are folded again.
    """
    schema = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"

    def fold(batches):
        index = CuckooIndex()
        for batch in batches:
            for digest, i, row, n in zip(*(c.to_pylist() for c in batch.columns)):
                index.insert(digest, NO_ID if i is None else i, row, n)
        found, step = list(index.entries()), 50_000
        for at in range(0, len(found), step):
            part = found[at : at + step]
            ids = pa.array([None if e[1] == NO_ID else e[1] for e in part], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([e[0] for e in part], pa.binary()), ids,
                    pa.array([e[2] for e in part], pa.int64()),
                    pa.array([e[3] for e in part], pa.int64()),
                ],
                ["digest", "keep_id", "keep_row", "group_size"],
            )

    single = rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("__row").alias("keep_row"),
                         F.lit(1).cast("bigint").alias("group_size"))
    return single.mapInArrow(fold, schema).repartition("digest").mapInArrow(fold, schema)


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are after every run of white space became one space; null
    counts as empty, and empty texts are copies of each other. Of equal texts the row with
    the smallest key stays (null keys come last); of rows with that key, the first stored
    one. An empty table gives an empty result. Other columns are not looked at. ``docs``
    must be a stored table. Keys are whole numbers.
    """
    rows = materialize(digests(docs, key, text), "digests")
    groups = copy_groups(rows)
    return rows.join(groups, "digest").select(
        "__row", F.col("doc_id").alias(key), "keep_id", "group_size",
        (F.col("__row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; see ``exact_copies``."""
    row = fresh(docs, "__row")
    gone = exact_copies(docs, key, text).filter(~F.col("kept")).select(F.col("__row").alias(row))
    tags = docs.withColumn(row, F.monotonically_increasing_id())
    return tags.join(gone, row, "left_anti").select(*[ref(c) for c in docs.columns])
