"""Secrets by pattern, and tokens that a battery of tests finds random. DataFrame functions only.

Every long token of letters and digits is a candidate; the smallest known alphabet that holds
its symbols is its encoding. Two questions are asked of it:

* Is it random? Chi-squared for even use of the alphabet, the number of runs above and below
  the middle of the alphabet, and the correlation of neighbouring symbols, each two-sided. A
  token that one of them rejects, at ``ALPHA`` for the three together, is none.
* Is it ordinary? The mean surprise of its symbols under the frequencies that they have in
  long words of the whole corpus, against its mean and variance for a token of that length.

Short tokens carry little evidence and there are many of them, so discoveries are controlled
within families of one encoding and one length class: by Benjamini and Hochberg's rule at most
a share of ``FALSE_SHARE`` of a family's discoveries is expected to be ordinary.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize

KINDS = ("assign", "access", "hex", "random")

# The patterns of the base kinds, and the characters their matches must have.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# A maximal run of hex digits is a match of its own, so the length may stand in the pattern.
HEX = rf"[0-9a-f]{{{LEAST['hex']},}}"

#: Characters of the shortest token that is tested, and of the words that tell what is ordinary.
TOKEN, WORD = 16, 8
ALPHA = 0.001
FALSE_SHARE = 0.01
#: Steps of a p-value's decimal logarithm, and their largest number.
STEPS, MOST_STEPS = 10, 3_000

_LOW, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_HIGH = _LOW.upper()
# The alphabets of encodings in their order, the smallest first. Digits alone are
# numbers, not secrets.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "hex-upper": _DIGITS + "ABCDEF",
    "base26": _LOW,
    "base26-upper": _HIGH,
    "base32": _HIGH + "234567",
    "base36": _DIGITS + _LOW,
    "base36-upper": _DIGITS + _HIGH,
    "base52": _HIGH + _LOW,
    "base62": _DIGITS + _HIGH + _LOW,
    "base64": _HIGH + _LOW + _DIGITS + "+/",
    "base64url": _HIGH + _LOW + _DIGITS + "-_",
}
SYMBOLS = _DIGITS + _HIGH + _LOW + "+/-_"


def _pieces(kind: str, text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of a pattern as an array: kind, number, characters before it, its own length,
    and the match (of a token) or the length of its group."""
    before = F.transform(F.split(text, pattern, -1), F.length)
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in sorted({0, group})]
    zipped = F.arrays_zip(before.alias("before"), *[m.alias(f"m{i}") for i, m in enumerate(found)])
    matched = F.filter(zipped, lambda x: x["m0"].isNotNull())
    return F.transform(
        matched,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("k"), x["before"].alias("before"), F.length(x["m0"]).alias("n"),
            F.length(x[f"m{len(found) - 1}"]).alias("held"),
            (x["m0"] if kind == "random" else F.lit(None).cast("string")).alias("token"),
        ),
    )


def find(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``__row``, ``doc_id``, ``kind``, ``start``, ``end`` and ``token`` of all base matches and
    all candidates; a row of kind ``''`` for each row of ``docs``."""
    whole = F.coalesce(ref(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), ref(key).alias("doc_id"), whole.alias("t"))
    t = F.col("t")
    # Most texts have none of a kind; to see that is cheaper than to cut the text.
    none = F.array().cast("array<struct<kind:string,k:int,before:int,n:int,held:int,token:string>>")
    parts = [
        F.when(F.lower(t).rlike(r"pass|secret|token|api"), _pieces("assign", t, ASSIGN, 2)).otherwise(none),
        F.when(t.contains("AKIA"), _pieces("access", t, ACCESS)).otherwise(none),
        F.when(t.rlike(HEX), _pieces("hex", t, HEX)).otherwise(none),
        F.when(t.rlike(rf"[A-Za-z0-9+/_-]{{{TOKEN},}}"), _pieces("random", t, rf"[A-Za-z0-9+/_-]{{{TOKEN},}}")).otherwise(none),
    ]
    frame = F.array(
        F.struct(F.lit("").alias("kind"), F.lit(0).alias("k"), F.lit(0).alias("before"), F.lit(0).alias("n"),
                 F.lit(0).alias("held"), F.lit(None).cast("string").alias("token"))
    )
    told = rows.select("__row", "doc_id", F.explode(F.concat(frame, *parts)).alias("x")).select("__row", "doc_id", "x.*")
    # All matches count for the places, those that are dropped too.
    up_to = F.sum(F.col("before") + F.col("n")).over(W.partitionBy("__row", "kind").orderBy("k"))
    placed = told.withColumn("end", up_to.cast("int")).withColumn("start", F.col("end") - F.col("n"))
    enough = reduce(lambda c, kind: c.when(F.col("kind") == kind, F.col("held") >= LEAST[kind]), LEAST, F.when(F.lit(False), True))
    return placed.filter(enough.otherwise(True)).select("__row", "doc_id", "kind", "start", "end", "token")


def symbol_counts(docs: DataFrame, text: str) -> dict[str, int]:
    """How often each symbol stands in words of ``WORD`` symbols or more, over all texts."""
    words = F.array_join(F.regexp_extract_all(F.coalesce(ref(text), F.lit("")), F.lit(rf"[A-Za-z0-9+/_-]{{{WORD},}}"), F.lit(0)), "")
    joined = docs.select(words.alias("w"))
    sums = [
        F.sum(F.length("w") - F.length(F.replace(F.col("w"), F.lit(c)))).alias(f"c{i}") for i, c in enumerate(SYMBOLS)
    ]
    found = joined.agg(*sums).first()
    return {c: found[i] or 0 for i, c in enumerate(SYMBOLS)}


def frequencies(counts: dict[str, int], alphabet: str) -> list[float]:
    """Shares of an alphabet's symbols. A letter counts in either case where the alphabet has
    only one: a word in capitals is as ordinary as in small letters."""
    both = set(_LOW) <= set(alphabet) and set(_HIGH) <= set(alphabet)
    held = [counts[c] + (counts[c.swapcase()] if c.isalpha() and not both else 0) + 1 for c in alphabet]
    return [h / sum(held) for h in held]


def _by_encoding(values: dict[str, Column]) -> Column:
    return reduce(lambda c, e: c.when(F.col("encoding") == e, values[e]), values, F.when(F.lit(False), None))


def tail_steps(z: Column) -> Column:
    """``STEPS`` times the negative decimal logarithm of the chance that a standard normal
    number is above ``z`` (of 0, if ``z`` is below), rounded down."""
    x = F.greatest(z, F.lit(0.0))
    # Abramowitz and Stegun, formula 26.2.17.
    k = 1 / (1 + 0.2316419 * x)
    series = k * (0.319381530 + k * (-0.356563782 + k * (1.781477937 + k * (-1.821255978 + k * 1.330274429))))
    log = -x * x / 2 - math.log(math.sqrt(2 * math.pi)) + F.log(series)
    steps = F.floor(-log * STEPS / math.log(10))
    return F.greatest(F.lit(0), F.least(F.lit(MOST_STEPS), steps)).cast("int")


def tested(candidates: DataFrame, counts: dict[str, int]) -> DataFrame:
    """Candidates of a known encoding with ``symbols`` (their number), ``z_even``, ``z_runs``,
    ``z_serial``, ``z_ordinary``, ``steps`` and ``size`` (the length class)."""
    encoding = reduce(
        lambda c, e: c.when(F.col("token").rlike(f"^[{ALPHABETS[e].replace('-', chr(92) + '-')}]+$"), e),
        ALPHABETS, F.when(F.col("token").rlike("^[0-9]+$"), None),
    )
    known = candidates.withColumn("encoding", encoding).filter("encoding is not null")
    half = {e: "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2) for e, a in ALPHABETS.items()}
    surprise, mean, variance = {}, {}, {}
    for e, a in ALPHABETS.items():
        f = frequencies(counts, a)
        surprise[e] = F.array(*[F.lit(-math.log(x)) for x in f])
        h = -sum(x * math.log(x) for x in f)
        mean[e], variance[e] = F.lit(h), F.lit(max(1e-9, sum(x * math.log(x) ** 2 for x in f) - h * h))
    laid = known.select(
        "*", F.length("token").alias("symbols"), _by_encoding({e: F.lit(a) for e, a in ALPHABETS.items()}).alias("alphabet"),
        _by_encoding({e: F.translate("token", a, half[e]) for e, a in ALPHABETS.items()}).alias("halves"),
    )
    held = F.transform(
        F.split("alphabet", ""), lambda c: F.col("symbols") - F.length(F.replace(F.col("token"), c, F.lit("")))
    )
    codes = F.transform(F.split("token", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double"))
    laid = laid.withColumn("held", held).withColumn("codes", codes)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    n = F.col("symbols").cast("double")
    m = F.length("alphabet").cast("double")
    changes = (2 * F.length("halves") - F.length(F.replace(F.col("halves"), F.lit("01"))) - F.length(F.replace(F.col("halves"), F.lit("10")))) / 2
    ones = (n - F.length(F.replace(F.col("halves"), F.lit("1")))).cast("double")
    squares = total(F.transform("held", lambda c: (c * c).cast("double")))
    laid = laid.select(
        "*", (m / n * squares - n).alias("chi"), ((m - 1) * n / (n - 1)).alias("df"),
        (changes + 1).alias("turns"), (1 + 2 * ones * (n - ones) / n).alias("turns_mean"),
        (total("codes") / n).alias("code_mean"),
        (total(F.zip_with("held", _by_encoding(surprise), lambda c, s: c * s)) / n).alias("surprise"),
    )
    off = F.transform("codes", lambda c: c - F.col("code_mean"))
    laid = laid.withColumn("off", off)
    lagged = total(F.zip_with(F.slice("off", F.lit(1), F.col("symbols") - 1), F.slice("off", F.lit(2), F.col("symbols") - 1), lambda a, b: a * b))
    spread = total(F.transform("off", lambda a: a * a))
    even = (F.pow(F.col("chi") / F.col("df"), 1 / 3) - (1 - 2 / (9 * F.col("df")))) / F.sqrt(2 / (9 * F.col("df")))
    turns_var = (F.col("turns_mean") - 1) * (F.col("turns_mean") - 2) / (n - 1)
    # A token in one half of its alphabet, or of one symbol, is as far from random as can be.
    runs = F.when(turns_var > 0, (F.col("turns") - F.col("turns_mean")) / F.sqrt(turns_var)).otherwise(-F.sqrt(n))
    serial = F.when(spread > 0, (lagged / spread + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.sqrt(n))
    ordinary = (F.col("surprise") - _by_encoding(mean)) * F.sqrt(n / _by_encoding(variance))
    return laid.select(
        *candidates.columns, "encoding", "symbols", even.alias("z_even"), runs.alias("z_runs"), serial.alias("z_serial"),
        ordinary.alias("z_ordinary"), tail_steps(ordinary).alias("steps"), F.floor(F.log2(n)).cast("int").alias("size"),
    )


def thresholds(tests: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """``encoding``, ``size``, ``from_steps``: from which step on a family's tokens are discoveries.

    p-values are rounded up to a step, which only makes the rule stricter. At most one row for
    an encoding and a power of two of lengths.
    """
    steps = tests.groupBy("encoding", "size", "steps").agg(F.count("*").alias("n"))
    family = W.partitionBy("encoding", "size")
    ranked = steps.select(
        "*", F.sum("n").over(family.orderBy(F.desc("steps"))).alias("rank"), F.sum("n").over(family).alias("all")
    )
    # p * all / rank <= share, in logarithms, as p may be too small for a double.
    fits = -F.col("steps") / STEPS + F.log10(F.col("all") / F.col("rank")) <= math.log10(share)
    return ranked.filter(fits).groupBy("encoding", "size").agg(F.min("steps").alias("from_steps"))


def random_tokens(candidates: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The candidates that are discoveries and that no test of randomness rejects."""
    tests = materialize(tested(candidates, counts), "token-tests")
    # The two-sided bound of a standard normal number for a third of ALPHA.
    bound = _normal_bound(ALPHA / 6)
    is_random = reduce(lambda a, b: a & b, [F.abs(F.col(c)) <= bound for c in ("z_even", "z_runs", "z_serial")])
    limits = F.broadcast(thresholds(tests))
    return tests.join(limits, ["encoding", "size"]).filter(is_random & (F.col("steps") >= F.col("from_steps")))


def _normal_bound(p: float) -> float:
    low, high = 0.0, 40.0
    for _ in range(80):
        z = (low + high) / 2
        low, high = (z, high) if math.erfc(z / math.sqrt(2)) / 2 > p else (low, z)
    return low


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``__row``, key, ``base`` and ``added``, arrays of spans by start.

    Base spans are the matches of the three patterns, per kind leftmost and without overlap,
    as structs of ``start``, ``end`` (code points, end exclusive), ``kind`` and ``encoding``
    (null); matches that are too short are dropped and not tried again. Added spans are of
    kind ``random``, have an encoding, and never touch a base span. Null texts count as empty;
    repeated rows give repeated results and count as often; an empty table gives none. Other
    columns are not looked at. ``docs`` must be a stored table; one text and its matches must
    fit into a task.
    """
    found = materialize(find(docs, key, text), "secret-matches")
    candidates = found.filter("kind = 'random'").select("__row", "start", "end", "token")
    chosen = random_tokens(candidates, symbol_counts(docs, text))
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = (
        found.filter("kind <> 'random'").select("__row", "doc_id", "kind", "start", "end", F.lit(None).cast("string").alias("encoding"))
        .unionByName(chosen.select("__row", F.lit("random").alias("kind"), "start", "end", "encoding"), allowMissingColumns=True)
        .withColumn("rank", kind)
    )
    # A running end of base spans from the left, and a running start from the right, tell of overlaps.
    is_base = F.col("kind").isin(*KINDS[:3])
    left = F.max(F.when(is_base, F.col("end"))).over(W.partitionBy("__row").orderBy("start", "rank"))
    right = F.min(F.when(is_base, F.col("start"))).over(W.partitionBy("__row").orderBy(F.desc("start"), F.desc("rank")))
    touched = F.coalesce(F.col("left") > F.col("start"), F.lit(False)) | F.coalesce(F.col("right") < F.col("end"), F.lit(False))
    free = spans.withColumn("left", left).withColumn("right", right).filter((F.col("kind") != "random") | ~touched)
    one = F.struct("start", "rank", "end", "kind", "encoding")
    of = lambda condition: F.transform(
        F.array_sort(F.collect_list(F.when(condition, one))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["encoding"].alias("encoding")),
    )
    return free.groupBy("__row").agg(
        F.max("doc_id").alias(key), of(is_base).alias("base"), of(F.col("kind") == "random").alias("added")
    )


def all_spans(base: Column, added: Column) -> Column:
    """Both arrays of spans together by start, then kind in the order of ``KINDS``."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
