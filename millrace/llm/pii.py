"""Personal data by pattern, and terms that give it away by what the corpus says about them.

A protected entity is a value found by pattern (an e-mail address, a card number). The
information content of an entity is ``log2(N / lines with it)``; what a term tells about it is
their pointwise mutual information over lines; a line meets what stands in it and in the lines
next to it. All words are terms, numbers and short ones too. A term whose share of the entity's
information reaches a threshold discloses it, wherever the term stands.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts, slices, tagged, words
from millrace.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Share of an entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Different lines in which a term must stand beside an entity.
SUPPORT = 3
#: Bits of the filter that preselects terms; fixed, so what is sent to tasks does not grow.
FILTER_BITS = 1 << 23
REMEMBERED = 500_000
#: Rows that a task lays out before it sends them.
AT_ONCE = 200_000

_DIGITS = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_MAIL_TOKEN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Numbers with single dots between: what lies between two dots or more is another run.
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_NUMBER = re.compile(r"[0-9]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, str, int, str]]:
    """Matches of ``EMAIL``, each run of its characters cut at the at signs: no part of a run is
    looked at twice, however long it is."""
    found = []
    for run in _MAIL_TOKEN.finditer(text):
        at, free = text.find("@", run.start(), run.end()), run.start()
        while at >= 0:
            after = text.find("@", at + 1, run.end())
            stop = after if after >= 0 else run.end()
            domain = _DOMAIN.match(text, at + 1, stop) if free < at else None
            if domain:
                found.append((free, "email", domain.end(), text[free : domain.end()].translate(_LOW)))
            free = domain.end() if domain else at + 1
            at = after
    return found


def _addresses(text: str) -> list[tuple[int, str, int, str]]:
    """Matches of ``IP``: of the numbers that stand in a row with a dot between, four and four."""
    found = []
    for run in _DOTTED.finditer(text):
        numbers = [(m.start(), m.end()) for m in _NUMBER.finditer(text, run.start(), run.end())]
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            if all(_at_most_255(text[s:e]) for s, e in four):
                start, end = four[0][0], four[3][1]
                found.append((start, "ip", end, text[start:end]))
    return found


def _at_most_255(number: str) -> bool:
    digits = number.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """``(start, kind, end, value)`` of all base matches, by start, then by kind."""
    found = _emails(text) if "@" in text else []
    if any(d in text for d in "0123456789"):
        if "." in text:
            found += _addresses(text)
        for m in CARD.finditer(text):
            digits = _DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end(), digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = _DIGITS.sub("", m.group())
                if 10 <= len(digits) <= 15:
                    found.append((m.start(), "phone", m.end(), digits))
    found.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return found


def _decoded(raw: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in raw]


def _lines_of(text: str, found) -> tuple[list[str], dict[int, set[str]], dict[int, list[tuple[int, int]]]]:
    """The lines of a text, the entities in each, and the stretches that matches take there."""
    # A match may run over a line end nowhere: no pattern allows one.
    lines = text.split("\n")
    starts = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
    inside, taken = defaultdict(set), defaultdict(list)
    for s, kind, e, value in found:
        k = int(np.searchsorted(starts, s, side="right")) - 1
        inside[k].add(f"{kind}:{value}")
        taken[k].append((s - int(starts[k]), e - int(starts[k])))
    return lines, inside, taken


def _hash(value: str | bytes) -> int:
    raw = value.encode() if isinstance(value, str) else value
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def find_base(rows: DataFrame) -> DataFrame:
    """``__row``, ``doc_id``, ``base``: the spans as structs, and ``met``: for each line with an
    entity, the hashes of the entity and of the five lines around, which are all that a term's
    evidence there is made of; ``rows`` is a ``tagged`` table."""

    def make():
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        pair = pa.list_(pa.struct([("entity", pa.int64()), ("block", pa.int64())]))

        def met(text, found):
            if not found:
                return []
            lines, inside, _ = _lines_of(text, found)
            out = []
            for k, values in inside.items():
                block = _hash("\n".join(lines[max(0, k - 2) : k + 3]))
                out += [{"entity": _hash(v), "block": block} for v in values]
            return out

        def work(part, raw):
            texts = _decoded(raw)
            found = [base_spans(t) for t in texts]
            spans = [[{"start": s, "kind": k, "end": e} for s, k, e, _ in f] for f in found]
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(spans, kind), pa.array(list(map(met, texts, found)), pair)],
                ["__row", "doc_id", "base", "met"],
            )

        return work

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(
        rows, make,
        f"__row bigint, doc_id {key}, base array<struct<start:int,kind:string,end:int>>, met array<struct<entity:bigint,block:bigint>>",
    )


def _line_terms(line: str, taken: list[tuple[int, int]]) -> set[bytes]:
    """Terms of a line outside the taken stretches."""
    for s, e in reversed(taken):
        line = line[:s] + " " * (e - s) + line[e:]
    return set(words(line.encode()))


def meetings(rows: DataFrame, bits: bytes) -> DataFrame:
    """``(entity, line, term)`` for each line that holds an entity of the filter ``bits``,
    repeated lines included: one row with a null term, and one for each term of the line and of
    the lines next to it. Entity and line are hashes; a term beside the entity has that of the
    line, another that of the lines from the entity's to the one behind the term's, so that
    copies of one block of lines are one."""
    names = ["entity", "line", "term"]

    def near_terms(lines, taken, k):
        terms = {}
        for step in (-1, 1, 0):
            if 0 <= k + step < len(lines):
                block = lines[max(0, k + min(0, 2 * step)) : k + max(0, 2 * step) + 1]
                terms.update(dict.fromkeys(_line_terms(lines[k + step], taken.get(k + step, [])), _hash("\n".join(block))))
        return terms

    def run(batches):
        probe = _Probe(bits)
        for batch in batches:
            for _, raw in slices(batch, "text"):
                entity, line, term, held = [], [], [], 0
                for t in _decoded(raw):
                    found = base_spans(t)
                    if not found:
                        continue
                    lines, inside, taken = _lines_of(t, found)
                    for k, values in inside.items():
                        known = sorted(h for h in map(_hash, values) if probe((_key(h),)))
                        if not known:
                            continue
                        terms = near_terms(lines, taken, k)
                        of, by = pa.array([None, *terms], pa.binary()), np.array([0, *terms.values()], np.int64)
                        for h in known:
                            entity.append(np.full(len(by), h))
                            line.append(by)
                            term.append(of)
                            held += len(by)
                            # A line with many of both is sent in pieces, never held as a whole.
                            if held > AT_ONCE:
                                yield _laid(names, entity, line, term)
                                entity, line, term, held = [], [], [], 0
                if held:
                    yield _laid(names, entity, line, term)

    return rows.mapInArrow(run, "entity bigint, line bigint, term binary")


def _laid(names, entity, line, term) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(entity)), pa.array(np.concatenate(line)), pa.concat_arrays(term)], names
    )


def _key(entity: int) -> bytes:
    """An entity's hash as a term of a filter."""
    return entity.to_bytes(8, "big", signed=True)


def _places(term: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh3_64_intdigest(term)
    return h % FILTER_BITS, (h >> 20) % FILTER_BITS, (h >> 40) % FILTER_BITS


def term_filter(terms: DataFrame) -> bytes:
    """A Bloom filter of ``FILTER_BITS`` bits over the terms, put together in the tasks."""

    def run(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                bits[list(_places(t))] = True
        blocks = np.packbits(bits).reshape(-1, 4096)
        full = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([b.tobytes() for b in blocks[full]], pa.binary())],
            ["block", "bits"],
        )

    def merge(group):
        joined = np.bitwise_or.reduce([np.frombuffer(bytes(b), np.uint8) for b in group["bits"]])
        return group.head(1).assign(bits=joined.tobytes())

    parts = terms.select("term").mapInArrow(run, "block int, bits binary")
    whole = bytearray(FILTER_BITS // 8)
    for r in parts.groupBy("block").applyInPandas(merge, "block int, bits binary").toLocalIterator():
        whole[4096 * r["block"] : 4096 * (r["block"] + 1)] = r["bits"]
    return bytes(whole)


class _Probe:
    """Membership of words in the filter, with the answers for recent words remembered."""

    def __init__(self, bits: bytes):
        self.bits, self.known = np.unpackbits(np.frombuffer(bits, np.uint8)), {}

    def __call__(self, found) -> list[bytes]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        out = []
        for w in found:
            yes = known.get(w)
            if yes is None:
                yes = known[w] = all(self.bits[p] for p in _places(w))
            if yes:
                out.append(w)
        return out


def line_counts(rows: DataFrame, bits: bytes) -> DataFrame:
    """``(term, n)``: lines with each term that passes the filter, and under a null term the
    number of all lines; summed up within each task, as long as the terms are not too many."""

    def told(counts, lines):
        return pa.RecordBatch.from_arrays(
            [pa.array([None, *counts], pa.binary()), pa.array([lines, *counts.values()], pa.int64())], ["term", "n"]
        )

    def run(batches):
        probe, counts, lines = _Probe(bits), Counter(), 0
        for batch in batches:
            for _, raw in slices(batch, "text"):
                for t in raw:
                    for text in t.split(b"\n"):
                        lines += 1
                        counts.update(set(probe(words(text))))
                if len(counts) > REMEMBERED:
                    yield told(counts, lines)
                    counts, lines = Counter(), 0
        yield told(counts, lines)

    counted = rows.mapInArrow(run, "term binary, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """``(term, share)``: terms that disclose an entity, with the largest share of its
    information. The counts are over all lines of all texts. ``base`` is the result of
    ``find_base``, which is asked anew if it is not given.

    An entity that stands in fewer than ``SUPPORT`` different blocks of lines can have no such
    term, so its lines are not laid out.
    """
    if base is None:
        base = find_base(rows.select(F.lit(0).cast("bigint").alias("__row"), F.lit(0).alias("doc_id"), "text"))
    seen = base.select(F.explode("met").alias("m")).select("m.entity", "m.block").distinct()
    often = seen.groupBy("entity").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT)
    key = F.unhex(F.lpad(F.hex("entity"), 16, "0"))
    met = materialize(meetings(rows, term_filter(often.select(key.alias("term")))), "meetings")
    of_entity = met.filter("term is null").groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = materialize(
        met.filter("term is not null").groupBy("entity", "term")
        .agg(F.count_distinct("line").alias("different"), F.count("*").alias("n_both"))
        .filter(F.col("different") >= SUPPORT), "meeting-pairs",
    )
    bits = term_filter(pairs.select("term").distinct())
    counts = materialize(line_counts(rows, bits), "line-counts")
    total = counts.filter("term is null").agg(F.sum("n")).first()[0] or 0
    if not total:
        return pairs.select("term", F.lit(0.0).alias("share")).limit(0)
    joined = pairs.join(of_entity, "entity").join(counts.filter("term is not null"), "term")
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    # A line between two of the entity's is next to both, but one line of evidence.
    both = F.least("n_both", "n")
    mutual = F.log2(F.lit(float(total)) * both / (F.col("n_entity") * F.col("n").cast("double")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    return joined.groupBy("term").agg(F.max(share).alias("share")).filter(F.col("share") >= GENERALISE)


def find_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``__row`` with ``found``: where disclosing terms stand, as structs with their share."""
    bits = term_filter(terms)

    def make():
        probe = _Probe(bits)

        def work(part, raw):
            row, term, start, end = [], [], [], []
            for r, t in zip(part.column(0).to_pylist(), raw):
                if not probe(set(words(t))):
                    continue
                text = t.decode("utf-8", "replace")
                for m in _TERM.finditer(text):
                    w = m.group().translate(_LOW).encode()
                    if probe((w,)):
                        row.append(r)
                        term.append(w)
                        start.append(m.start())
                        end.append(m.end())
            return pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(term, pa.binary()),
                 pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                ["__row", "term", "start", "end"],
            )

        return work

    hits = map_texts(rows, make, "__row bigint, term binary, start int, end int").join(terms, "term")
    return hits.groupBy("__row").agg(F.collect_list(F.struct("start", "end", "share")).alias("found"))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``__row``, key, ``base`` and ``added``, arrays of spans by start.

    Base spans are the matches of the four patterns, as structs of start, kind and end in
    code points, end exclusive. Added spans are of kind ``term``, carry ``share``, and never
    touch a base span. Null texts count as empty; repeated rows are repeated evidence for
    counts, but only different lines count as support; an empty table gives an empty
    result. ``docs`` must be a stored table; other columns are not looked at.
    """
    rows = tagged(docs, key, text).toDF("__row", "doc_id", "text")
    base = materialize(find_base(rows), "base-spans")
    terms = materialize(disclosing_terms(rows.select("__row", "text"), base), "disclosing-terms")
    added = find_terms(rows.select("__row", "text"), terms)
    free = F.filter(
        F.array_sort(F.coalesce("found", F.expr("array()"))),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return base.join(added, "__row", "left").select(
        "__row", F.col("doc_id").alias(key), "base", free.alias("added")
    )


def span_text(spans_of: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans_of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def all_spans(base: Column, added: Column) -> Column:
    """Base and added spans together by start; of one start the kinds in the order of ``KINDS``."""
    rank = lambda kind: F.array_position(F.array(*map(F.lit, KINDS)), kind)
    both = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.transform(added, lambda s: F.struct(s["start"].alias("start"), F.lit(5).cast("bigint").alias("k"), s["end"].alias("end"), F.lit("term").alias("kind"))),
    )
    return F.array_sort(both)


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``sanitised``: base matches become their kind in brackets, terms from
    ``REMOVE`` on ``[...]``, terms from ``GENERALISE`` on ``[term]``; null texts stay null."""
    out = fresh(docs, "sanitised")
    row, spans_column = fresh(docs, "__row"), fresh(docs, "__spans")
    found = spans(docs, key, text).select(
        F.col("__row").alias(row),
        F.concat(
            F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("by"))),
            F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, "[...]").otherwise("[term]").alias("by"))),
        ).alias(spans_column),
    )
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(found, row)
    value = ref(text)
    # From the end on, so that places before a replacement stay as they are.
    ordered = F.reverse(F.array_sort(ref(spans_column)))
    state = F.struct(value.alias("t"), F.lit(1 << 30).alias("limit"))
    done = F.aggregate(
        ordered, state,
        lambda a, s: F.when(
            s["end"] <= a["limit"],
            F.struct(
                F.concat(F.substring(a["t"], F.lit(1), s["start"]), s["by"], F.substring(a["t"], s["end"] + 1, F.length(a["t"]))).alias("t"),
                s["start"].alias("limit"),
            ),
        ).otherwise(a),
    )
    return joined.select(*[ref(c) for c in docs.columns], done["t"].alias(out))
