"""Runs of repeating words, found by direct lag scans and multi-scale minimizers.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical), at
least ``max(MIN_WORDS, MIN_PERIODS * q)`` long, that no neighbouring word extends.

Periods up to ``SHORT`` are looked for by comparing the words with themselves at every such
distance. Longer ones are cut into scales. A scale looks for periods in ``(low, high]`` with
k-grams of ``high`` words: inside a run of period ``q <= high`` two equal k-grams are never
closer than ``q``, or else the run had a smaller period (Fine and Wilf). Two windows of
k-grams that stand ``q`` apart inside a run hold the same k-grams and so the same minima, and
with windows of ``2 * (low + 1) + 1 - high`` k-grams both windows fit into three periods. So
the next place with the same minimizer is exactly ``q`` words on, for every run of the scale;
such pairs are extended word by word, which also drops pairs that are not in a run.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts, tagged

MIN_WORDS = 24
MIN_PERIODS = 3
#: Periods found by direct scans; longer ones by minimizers.
SHORT = 24

# Two primes below 2 ** 31 and a base for each; a k-gram's hash has 62 bits.
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1664525)


def scales(longest: int) -> list[tuple[int, int, int]]:
    """``(low, high, window)`` for periods above ``SHORT`` in a text of ``longest`` words."""
    out, low = [], SHORT
    while low < longest // MIN_PERIODS:
        high = (low + 1) * 3 // 2
        out.append((low, high, 2 * (low + 1) + 1 - high))
        low = high
    return out


@cache
def _powers(base: int, prime: int, log: int) -> np.ndarray:
    """``base ** i`` modulo ``prime`` for ``i`` below ``2 ** log``."""
    out = np.ones(1, np.int64)
    while len(out) < 1 << log:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out


class KGrams:
    """Hashes of the k-grams of a sequence, for any k."""

    def __init__(self, ids: np.ndarray):
        log = max(1, int(len(ids)).bit_length())
        self.parts = []
        for base, prime in zip(_BASES, _PRIMES):
            sums = np.zeros(len(ids) + 1, np.int64)
            np.cumsum((ids + 1) * _powers(base, prime, log)[: len(ids)] % prime, out=sums[1:])
            self.parts.append((sums, _powers(pow(base, -1, prime), prime, log), prime))

    def __call__(self, k: int) -> np.ndarray:
        high, low = ((s[k:] - s[:-k]) % p * back[: len(s) - k] % p for s, back, p in self.parts)
        return (high << 31) ^ low


def _windows(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` values in a row: block prefixes meet block suffixes."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, values[-1])
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = pick.accumulate(grid, axis=1).ravel()
    behind = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the k-grams that are least in one of the windows they stand in, all of equal ones."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    # A product spreads equal words over the order; hashes of 62 bits stay different.
    order = grams * np.int64(0x5851F42D4C957F2D)
    least = _windows(order, window, np.minimum)
    # A place is chosen if the largest of the minima around it is its own value.
    edge = np.full(window - 1, np.iinfo(np.int64).min)
    around = _windows(np.concatenate([edge, least, edge]), window, np.maximum)
    return np.flatnonzero(around == order)


def _extend(ids: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``i`` in which words ``lag`` apart are identical, as
    ``(start, end)``; ``ids[i] == ids[i + lag]`` must hold."""
    step, right = 64, i + 1
    while right + lag < len(ids):
        stop = min(right + step, len(ids) - lag)
        same = ids[right:stop] == ids[right + lag : stop + lag]
        if same.all():
            right, step = right + len(same), 2 * step
        else:
            right += int(np.argmin(same))
            break
    step, left = 64, i
    while left > 0:
        at = max(0, left - step)
        same = ids[at:left] == ids[at + lag : left + lag]
        if same.all():
            left, step = at, 2 * step
        else:
            left -= int(np.argmin(same[::-1]))
            break
    return left, right + lag


def _lag_runs(ids: np.ndarray, lag: int) -> list[tuple[int, int, int]]:
    """``(start, end, lag)`` of all long enough stretches that repeat at ``lag``."""
    if len(ids) <= lag:
        return []
    same = np.zeros(len(ids) - lag + 2, np.int8)
    same[1:-1] = ids[lag:] == ids[:-lag]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2] + lag
    use = ends - starts >= max(MIN_WORDS, MIN_PERIODS * lag)
    return [(s, e, lag) for s, e in zip(starts[use].tolist(), ends[use].tolist())]


def _seeded_runs(ids: np.ndarray, grams: KGrams, low: int, high: int, window: int) -> list[tuple[int, int, int]]:
    """Stretches with a lag in ``(low, high]`` from pairs of equal minimizers."""
    if len(ids) < high + window:
        return []
    hashes = grams(high)
    places = minimizers(hashes, window)
    order = np.lexsort((places, hashes[places]))
    places, values = places[order], hashes[places[order]]
    lags = np.diff(places)
    use = (values[1:] == values[:-1]) & (lags > low) & (lags <= high)
    found, done = [], {}
    pairs = np.stack([lags[use], places[:-1][use]], 1)
    for lag, i in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        # Pairs of one lag come by place, so those of a stretch come one after the other.
        if i < done.get(lag, 0) or ids[i] != ids[i + lag]:
            continue
        start, end = _extend(ids, i, lag)
        done[lag] = end - lag
        if end - start >= max(MIN_WORDS, MIN_PERIODS * lag):
            found.append((start, end, lag))
    return found


def find_runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of a sequence of word numbers, by start, then period.

    Several texts may be laid in a row with numbers between them that occur once, as no run
    reaches over such a number; ``longest`` is then the length of the longest text.
    """
    found = []
    for lag in range(1, SHORT + 1):
        found += _lag_runs(ids, lag)
    steps = scales(len(ids) if longest is None else longest)
    if steps:
        grams = KGrams(ids)
        for low, high, window in steps:
            found += _seeded_runs(ids, grams, low, high, window)
    # A multiple of the period repeats over the same stretch; so only the least one counts.
    least: dict[tuple[int, int], int] = {}
    for start, end, lag in found:
        least[start, end] = min(lag, least.get((start, end), lag))
    return sorted((s, e, q) for (s, e), q in least.items())


def numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, their numbers with a number that occurs once behind each text,
    and the place where each text starts."""
    known: dict[bytes, int] = {}
    split, starts, ids, at = [], [], [], 0
    for t in texts:
        w = t.split()
        split.append(w)
        starts.append(at)
        ids += [known.setdefault(x, len(known)) for x in w]
        ids.append(-1)
        at += len(w) + 1
    out = np.array(ids, np.int64)
    ends = np.flatnonzero(out == -1)
    out[ends] = len(known) + np.arange(len(ends))
    return split, out, np.array(starts, np.int64)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``__row``, key, ``n_words``, ``runs`` and ``collapsed``.

    Words are parted by blanks, tabs and line ends and compared as they are, from 0 on.
    ``runs`` are structs of ``start``, ``length`` and ``period`` in words, by start, then
    period; different runs may overlap. ``collapsed`` are the words, joined by one space, but
    for those that a run holds after its first period. A null or empty text has no words, no
    runs and an empty ``collapsed``; repeated rows give repeated results; an empty table gives
    none. Other columns are not looked at. Texts are never split: a text is handled whole, in
    memory for its words and about ten numbers a word. Hashes only propose where to look;
    a run could be missed only if two different k-grams of one slice had the same 62 bits.
    """
    rows = tagged(docs, key, text).toDF("__row", "doc_id", "text")

    def make():
        def work(part, raw):
            split, ids, starts = numbered(raw)
            longest = max(map(len, split), default=0)
            per_text: list[list[dict]] = [[] for _ in raw]
            kept: dict[int, np.ndarray] = {}
            for start, end, period in find_runs(ids, longest):
                t = int(np.searchsorted(starts, start, side="right")) - 1
                first = start - int(starts[t])
                per_text[t].append({"start": first, "length": end - start, "period": period})
                kept.setdefault(t, np.ones(len(split[t]), bool))[first + period : first + end - start] = False
            out = [
                b" ".join(w if t not in kept else [x for x, keep in zip(w, kept[t].tolist()) if keep])
                for t, w in enumerate(split)
            ]
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(w) for w in split], pa.int64()),
                 pa.array(per_text, pa.list_(RUN)), pa.array(out, pa.binary()).cast(pa.string())],
                ["__row", "doc_id", "n_words", "runs", "collapsed"],
            )

        return work

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"__row bigint, doc_id {kind}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
    return map_texts(rows, make, schema).withColumnRenamed("doc_id", key)


def strongest(runs):
    """Of an array of runs, as ``repeats`` gives it, that with the greatest length for its
    period; of equal ones the first. Null for an empty array."""
    more = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda a, r: F.when(more(a, r), r).otherwise(a))


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by its collapsed words where it has a run; texts without
    one, null texts too, stay as they are, byte for byte. ``docs`` must be a stored table."""
    row, short = fresh(docs, "__row"), fresh(docs, "__collapsed")
    found = repeats(docs, key, text).filter(F.size("runs") > 0)
    found = found.select(F.col("__row").alias(row), F.col("collapsed").alias(short))
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(found, row, "left")
    return joined.select(
        *[F.coalesce(ref(short), ref(c)).alias(c) if c == text else ref(c) for c in docs.columns]
    )
