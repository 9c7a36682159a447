"""Byte-level BPE: merges replayed in rank order over all words of a slice at once."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts

#: Text bytes whose words are merged together.
REPLAY_BYTES = 16 << 20
#: Words, and their bytes, that are kept from slice to slice; beyond, all are forgotten.
KNOWN_WORDS, KNOWN_BYTES = 800_000, 16 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 token, blank, rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Ids of many words by one pass over the merges in rank order.

    All words lie in one array of tokens, linked to their neighbours. The inverted index
    maps the rank that two neighbours merge to onto the places where they stand. Ranks are
    taken from a heap; all places of a rank are merged at once and only the pairs beside
    them are looked up anew. When a merge brings up a pair of a lower rank in a word, the
    order inside that word matters: such words are merged again one step at a time.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys)
        self.pairs = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(merged, np.int64)[order], -1)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they do not merge."""
        keys = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.merged[at], -1)

    def one(self, word: bytes) -> list[int]:
        """The lowest rank first, leftmost on a tie, one merge at a time."""
        ranks, n = self.ranks, len(word)
        parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
        after, before = [*range(1, n), n], [-1, *range(n - 1)]
        heap: list[tuple[int, int]] = []

        def look(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n:
                rank = ranks.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i))

        for i in range(n):
            look(i)
        while heap:
            rank, i = heapq.heappop(heap)
            if parts[i] is None or after[i] == n or ranks.get(parts[i] + parts[after[i]]) != rank:
                continue
            j = after[i]
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            look(before[i])
            look(i)
        return [ranks[p] for p in parts if p is not None]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        filled = sizes > 0
        after[ends[filled] - 1] = -1
        before[(ends - sizes)[filled]] = -1
        index: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []

        def note(places: np.ndarray, found: np.ndarray) -> None:
            good = found >= 0
            places, found = places[good], found[good]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for r, at in zip(found[np.append(0, cuts)].tolist() if len(found) else [], np.split(places, cuts)):
                if r not in index:
                    heapq.heappush(heap, r)
                index[r].append(at)

        first = np.flatnonzero(after >= 0).astype(np.int32)
        note(first, self._rank(token[first], token[first + 1]))
        odd: list[np.ndarray] = []
        while heap:
            r = heapq.heappop(heap)
            found = index.pop(r)
            p = np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
            p = p[(token[p] >= 0) & (after[p] >= 0)]
            p = p[self._rank(token[p], token[after[p]]) == r]
            if not len(p):
                continue
            # Of overlapping places, as in a run of one letter, every second one merges.
            chained = np.append(False, after[p[:-1]] == p[1:])
            if chained.any():
                place = np.arange(len(p))
                run = np.maximum.accumulate(np.where(chained, 0, place))
                p = p[(place - run) % 2 == 0]
            q = after[p]
            token[p], token[q] = r, -1
            nn = after[q]
            after[p] = nn
            has = nn >= 0
            before[nn[has]] = p[has]
            pr = before[p]
            new = np.unique(np.concatenate([pr[pr >= 0], p[has]]))
            ranks = self._rank(token[new], token[after[new]])
            low = (ranks >= 0) & (ranks < r)
            if low.any():
                odd.append(new[low])
            note(new, ranks)
        alive = token >= 0
        ids = token[alive]
        count = np.concatenate([[0], np.cumsum(alive)])
        stops, starts = count[ends].tolist(), count[ends - sizes].tolist()
        flat = ids.tolist()
        out = [flat[a:b] for a, b in zip(starts, stops)]
        if odd:
            for k in set(np.searchsorted(ends, np.concatenate(odd), side="right").tolist()):
                out[k] = self.one(words[k])
        return out


class Encoder:
    """Texts to ids. Texts are first written as numbers of distinct words; the words that are
    new are merged together, and the ids of a text are gathered from those of its words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.replay = MergeReplay(ranks)
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.bytes = 0

    def _learn(self, first: int) -> None:
        """Ids of the words from number ``first`` on."""
        raw = [w.encode() for w in islice(self.number, first, None)]
        if not raw:
            return
        self.bytes += sum(map(len, raw))
        whole = list(map(self.ranks.get, raw))
        merged = iter(self.replay.encode([w for w, i in zip(raw, whole) if i is None]))
        found = [next(merged) if i is None else (i,) for i in whole]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        if len(self.number) > KNOWN_WORDS or self.bytes > KNOWN_BYTES:
            self._forget()
        first, number = len(self.number), self.number
        coded = []
        for t in texts:
            words = self.split.findall(t)
            coded.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self._learn(first)
        for codes in coded:
            begin = self.starts[codes]
            sizes = self.starts[codes + 1] - begin
            ends = np.cumsum(sizes)
            shift = np.repeat(begin - (ends - sizes), sizes)
            yield self.ids[shift + np.arange(len(shift))]


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with the column ``ids`` (array of int; a clashing name gets a ``_``).

    ``path`` names a rank file on the driver, ``pattern`` splits a text into words, each
    merged separately; a word that is a token is that token. Null and empty texts give an
    empty array; bytes that are no UTF-8 become U+FFFD first. Rows are independent, so
    repeated rows, null keys and an empty table need no rule.
    """
    out = fresh(docs, ids)
    with open(path, "rb"):  # fails here rather than in the tasks
        ranks = load_ranks(path)

    def make():
        encoder = Encoder(ranks, pattern)

        def work(part, raw):
            rows = list(encoder.encode(t.decode("utf-8", "replace") for t in raw))
            return pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(rows, pa.list_(pa.int32()))], [*part.schema.names, out]
            )

        return work

    schema = docs.select("*", F.expr("cast(null as array<int>)").alias(out)).schema
    return map_texts(docs, make, schema, text, REPLAY_BYTES)


def token_digests(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by blanks) and
    ``decoded_sha256`` (of the bytes the ids stand for); rules as for ``encode``."""
    ranks = load_ranks(path)
    rows = docs.select(ref(key), ref(text).alias("text" if key != "text" else "text_"))

    def make():
        encoder = Encoder(ranks, pattern)
        bytes_of = {i: t for t, i in ranks.items()}
        digits_of = {i: str(i) for i in bytes_of}

        def work(part, raw):
            n, a, b = [], [], []
            for found in encoder.encode(t.decode("utf-8", "replace") for t in raw):
                ids = found.tolist()
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(digits_of.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(b"".join(map(bytes_of.__getitem__, ids))).hexdigest())
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    schema = rows.select(
        ref(key), F.lit(0).cast("bigint").alias("n_tokens"), F.lit("").alias("ids_sha256"),
        F.lit("").alias("decoded_sha256"),
    ).schema
    return map_texts(rows, make, schema, rows.columns[1], REPLAY_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; null ids give null."""
    out = fresh(df, text)
    bytes_of = {i: t for t, i in load_ranks(path).items()}

    def run(batches):
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [
                None if r is None else b"".join(map(bytes_of.__getitem__, r)).decode("utf-8", "replace")
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out]
            )

    return df.mapInArrow(run, df.select("*", F.lit(None).cast("string").alias(out)).schema)
