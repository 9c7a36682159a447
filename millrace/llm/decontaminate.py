"""Benchmark passages in documents, found by Wu-Manber search over word text."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts, words
from millrace.session import materialize

WINDOW = 13
#: Bytes of test strings that one search table holds; more are searched in further blocks.
BLOCK_BYTES = 16 << 20


class WuManber:
    """Occurrences of many byte strings at once.

    Only the first ``m`` bytes of a string, ``m`` being the shortest length, take part in
    the shift table: a block of ``size`` bytes that ends ``d`` bytes before the end of such
    a prefix allows a move by ``d``, a block in no prefix a move past it. Where the move is
    zero the block selects the strings whose prefix ends in it, which are compared whole.
    """

    def __init__(self, strings: list[bytes]):
        self.m = min(map(len, strings))
        wanted = math.ceil(math.log(2 * self.m * len(strings), 16)) + 1
        self.size = max(1, min(self.m, wanted))
        self.far = self.m - self.size + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = defaultdict(list)
        for s in strings:
            for end in range(self.size, self.m + 1):
                block, move = s[end - self.size : end], self.m - end
                if self.shift.get(block, self.far) > move:
                    self.shift[block] = move
            self.bucket[s[self.m - self.size : self.m]].append(s)

    def scan(self, text: bytes) -> list[tuple[int, bytes]]:
        """Every (start, string), overlaps included."""
        found, move_of, far, size, m = [], self.shift.get, self.far, self.size, self.m
        at, end = m, len(text)
        while at <= end:
            block = text[at - size : at]
            move = move_of(block, far)
            if move:
                at += move
                continue
            start = at - m
            found += [(start, s) for s in self.bucket[block] if text.startswith(s, start)]
            at += 1
        return found


def searchers(strings: list[bytes]) -> list[WuManber]:
    """Tables by length class, so that one short string does not shorten all moves."""
    classes = defaultdict(list)
    for s in strings:
        classes[max(len(s), 1).bit_length()].append(s)
    return [WuManber(group) for group in classes.values()]


def windows(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """Distinct ``(item, window)``; a window is the word text with a space at either end."""

    def make():
        def work(part, raw):
            ids, out = [], []
            for i, t in zip(part.column(0).to_pylist(), raw):
                w = words(t)
                for k in range(max(1, len(w) - width + 1) if w else 0):
                    ids.append(i)
                    out.append(b" " + b" ".join(w[k : k + width]) + b" ")
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(out, pa.binary())], ["item", "window"]
            )

        return work

    # An item without an id is still a passage; it counts under the name "null".
    rows = benchmark.select(
        F.coalesce(ref(item).cast("string"), F.lit("null")).alias("item"), ref(text).alias("text")
    )
    return map_texts(rows, make, "item string, window binary").distinct()


def _finder(tests: dict[bytes, list[str]]):
    """``make`` for ``map_texts``-like work: hit words and items of each text."""

    def make():
        tables = searchers(list(tests)) if tests else []

        def find(t: bytes) -> tuple[int, list[int], list[str]]:
            w = words(t)
            if not w or not tables:
                return len(w), [], []
            line = b" " + b" ".join(w) + b" "
            found = [x for table in tables for x in table.scan(line)]
            if not found:
                return len(w), [], []
            starts = np.cumsum([0, *(len(x) + 1 for x in w[:-1])])
            hit = np.zeros(len(w), bool)
            for at, s in found:
                k = int(np.searchsorted(starts, at))
                hit[k : k + s.count(b" ") - 1] = True
            items = sorted({i for _, s in found for i in tests[s]})
            return len(w), np.flatnonzero(hit).tolist(), items

        return find

    return make


def _blocks(benchmark: DataFrame, item: str, text: str, width: int):
    """Test strings with their items, block by block; one block is all a driver ever holds."""
    rows = materialize(windows(benchmark, item, text, width), "windows")
    total = rows.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    part = F.pmod(F.xxhash64("window"), F.lit(n))
    for k in range(n):
        tests = defaultdict(list)
        for r in rows.filter(part == k).toLocalIterator():
            tests[bytes(r["window"])].append(r["item"])
        yield dict(tests)


def _hits(rows: DataFrame, tests: dict[bytes, list[str]]) -> DataFrame:
    def make():
        find = _finder(tests)()

        def work(part, raw):
            n, hit, items = zip(*map(find, raw))
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()),
                 pa.array(hit, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["__row", "doc_id", "n_words", "hit", "items"],
            )

        return work

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"__row bigint, doc_id {kind}, n_words bigint, hit array<int>, items array<string>"
    return map_texts(rows, make, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", width: int = WINDOW,
) -> DataFrame:
    """Per row: key, ``n_words``, ``hit`` (places of words inside an occurrence of a window
    of a benchmark item), ``items`` (the items' ids as text, sorted) and ``contaminated``.

    A window is ``width`` consecutive words of an item; a shorter item is one window, an
    item without words none. A document is contaminated when at least one word and at least
    a twentieth of its words are hit. Null texts have no words. Repeated rows give repeated
    results. Empty documents or an empty benchmark give no hits. A benchmark of more than
    ``BLOCK_BYTES`` is searched in several passes; ``docs`` must then be a stored table.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), ref(key).alias("doc_id"),
                       ref(text).alias("text"))
    parts = [_hits(rows, tests) for tests in _blocks(benchmark, item, item_text, width)]
    found = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            found = found.unionByName(p)
        found = found.groupBy("__row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    n_hit = F.size("hit")
    return found.select(
        F.col("doc_id").alias(key), "n_words", "hit", "items",
        ((n_hit > 0) & (20 * n_hit.cast("bigint") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text",
    item: str = "item_id", item_text: str = "text", width: int = WINDOW,
) -> DataFrame:
    """``docs`` without the contaminated rows, see ``contamination``; one pass over the rows
    and no shuffle of texts for each block of the benchmark but the last, one for all in
    the usual case of a single block."""
    blocks = list(_blocks(benchmark, item, item_text, width))
    if len(blocks) > 1:
        row = fresh(docs, "__row")
        keyed = docs.withColumn(row, F.monotonically_increasing_id())
        bad = contamination(
            keyed, benchmark, row, text, item, item_text, width
        ).filter("contaminated").select(ref(row))
        return keyed.join(bad, row, "left_anti").select(*[ref(c) for c in docs.columns])

    def make():
        find = _finder(blocks[0])()

        def work(part, raw):
            keep = []
            for t in raw:
                n, hit, _ = find(t)
                keep.append(not (hit and 20 * len(hit) >= n))
            return part.filter(pa.array(keep, pa.bool_()))

        return work

    return map_texts(docs, make, docs.schema, text)
