"""Quality scores by a sparse ensemble of rules over text statistics.

Paths of small trees become conjunctive rules, an L1-penalised logistic fit keeps few of
them, and what is left is compiled into one Spark column expression.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts
from millrace.session import materialize

#: Labelled rows that the fit looks at, at most: those with the smallest hashes of their keys.
MAX_ROWS = 20_000
TREES, DEPTH, SEED = 16, 3, 17
PENALTY = 0.002
#: Parts of the training table; fixed, as the bags of the trees are drawn part by part.
FIT_PARTS = 6
CUT = 0.3

STATISTICS = [
    "n_bytes", "n_words", "n_lines", "mean_word", "sd_word", "long_words", "short_words",
    "words_per_line", "upper", "digit", "space", "newline", "stop", "comma", "mark", "symbol",
    "pipe", "quote", "high", "entropy", "distinct_words", "top_word", "repeated_lines",
    "caps_words", "ended_lines", "bare_words", "symbol_words", "short_lines",
]

_CLASSES = {
    "upper": bytes(range(65, 91)), "digit": b"0123456789", "space": b" \t", "newline": b"\n",
    "stop": b".", "comma": b",;:", "mark": b"!?", "symbol": b"#$%&*+/<=>@[\\]^_`{}~", "pipe": b"|",
    "quote": b"\"'()-", "high": bytes(range(128, 256)),
}


def statistics_of(raw: bytes) -> list[float]:
    """The values of ``STATISTICS`` for one text; shares of an empty text are 0."""
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = hist[hist > 0] / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    words = raw.split()
    w = len(words) or 1
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    share = {k: float(hist[list(v)].sum()) / n for k, v in _CLASSES.items()}
    m = len(lines) or 1
    values = {
        "n_bytes": np.log1p(n), "n_words": np.log1p(len(words)), "n_lines": np.log1p(len(lines)),
        "mean_word": sizes.mean(), "sd_word": sizes.std(), "long_words": (sizes > 12).sum() / w,
        "short_words": (sizes <= 2).sum() / w, "words_per_line": w / m,
        "entropy": -(p * np.log2(p)).sum(), "distinct_words": len(counts) / w,
        "top_word": max(counts.values(), default=0) / w, "repeated_lines": 1 - len(set(lines)) / m if lines else 0,
        "caps_words": sum(map(bytes.isupper, words)) / w,
        "ended_lines": sum(x.rstrip()[-1:] in b".!?" for x in lines) / m,
        "bare_words": sum(map(bytes.isalpha, words)) / w,
        "symbol_words": len(re.findall(rb"[#$%&*!|](?=\s|$)", raw)) / w,
        "short_lines": sum(len(x) < 30 for x in lines) / m,
    } | share
    return [float(values[k]) for k in STATISTICS]


def with_statistics(df: DataFrame, text: str, column: str) -> DataFrame:
    """``df`` with the array of statistics of the text, in the order of ``STATISTICS``."""

    def make():
        def work(part, raw):
            rows = [statistics_of(t) for t in raw]
            return pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(rows, pa.list_(pa.float64()))], [*part.schema.names, column]
            )

        return work

    schema = df.select("*", F.expr("cast(null as array<double>)").alias(column)).schema
    return map_texts(df, make, schema, text)


# A rule is a tuple of (statistic number, at most?, threshold); all must hold.
Rule = tuple[tuple[int, bool, float], ...]


def tree_paths(node, path: Rule = ()) -> list[Rule]:
    """The conditions from the root to every other node of a fitted tree."""
    found = [path] if path else []
    if node.subtreeDepth() > 0:
        k, cut = node.split().featureIndex(), node.split().threshold()
        found += tree_paths(node.leftChild(), (*path, (k, True, cut)))
        found += tree_paths(node.rightChild(), (*path, (k, False, cut)))
    return found


def simplified(rule: Rule) -> Rule:
    """One condition per statistic and direction, the tightest, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for k, low, cut in rule:
        old = tight.get((k, low))
        tight[k, low] = cut if old is None else min(old, cut) if low else max(old, cut)
    return tuple((k, low, cut) for (k, low), cut in sorted(tight.items()))


def holds(rule: Rule, stats: Column) -> Column:
    out = None
    for k, low, cut in rule:
        one = stats[k] <= F.lit(cut) if low else stats[k] > F.lit(cut)
        out = one if out is None else out & one
    return out


@dataclass
class RuleEnsemble:
    """Weighted rules; ``score`` is a column expression over the statistics array."""

    base: float
    rules: list[tuple[Rule, float]]

    def score(self, stats: Column) -> Column:
        logit = F.lit(self.base)
        for rule, weight in self.rules:
            logit = logit + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

    def describe(self) -> list[str]:
        def text(rule):
            return " and ".join(f"{STATISTICS[k]} {'<=' if low else '>'} {cut:.4g}" for k, low, cut in rule)

        return [f"{w:+.3f} if {text(r)}" for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def fit_rules(train: DataFrame, stats: str, label: str) -> RuleEnsemble:
    """Fit on a stored table of statistics and labels 0 or 1.

    Without rows the score is a constant half, with one class only a constant near it.
    """
    n, good = train.agg(F.count(label), F.sum(label)).first()
    n, good = n or 0, good or 0
    share = (good + 0.5) / (n + 1)
    constant = RuleEnsemble(float(np.log(share / (1 - share))), [])
    if not 0 < good < n:
        return constant
    rows = train.select(array_to_vector(ref(stats)).alias("features"), F.col(label).cast("double").alias("label"),
                        ref(stats).alias("stats")).cache()
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", minInstancesPerNode=5
    ).fit(rows)
    paths = {simplified(p) for tree in forest.trees for p in tree_paths(tree._call_java("rootNode"))}
    rules = sorted(paths)
    if not rules:
        rows.unpersist()
        return constant
    marks = F.array(*[holds(r, F.col("stats")).cast("double") for r in rules])
    matrix = rows.select("label", array_to_vector(marks).alias("rules")).cache()
    lasso = LogisticRegression(
        featuresCol="rules", elasticNetParam=1.0, regParam=PENALTY, maxIter=40, standardization=False
    ).fit(matrix)
    rows.unpersist()
    matrix.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0])


def held_out(key: Column) -> Column:
    """Rows that no fit may see: CRC-32 of the key as text leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int
) -> DataFrame:
    """Statistics and labels of at most ``max_rows`` labelled rows, stored in a fixed order.

    Rows without key or label, and held-out ones, are not used.
    """
    chosen = (
        labels.select(ref(key).alias("key"), ref(label).cast("int").alias("label"))
        .filter("key is not null and label in (0, 1)").filter(~held_out(F.col("key")))
        .orderBy(F.xxhash64("key"), "key", "label").limit(max_rows)
    )
    # At most max_rows rows of two numbers: small enough to be sent to every task.
    found = docs.select(ref(key).alias("key"), ref(text).alias("text")).join(F.broadcast(chosen), "key")
    scored = with_statistics(found, "text", "stats").select("key", "label", "stats")
    fixed = materialize(scored, "training-rows").repartition(FIT_PARTS, "key")
    return materialize(fixed.sortWithinPartitions("key", "label", "stats"), "training-rows")


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", max_rows: int = MAX_ROWS,
) -> RuleEnsemble:
    return fit_rules(training_rows(docs, labels, key, text, label, max_rows), "stats", "label")


def scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", cut: float = CUT, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Per row: key, ``held_out``, ``score`` (probability of label 1) and ``predicted``.

    Only statistics of the text enter a score. Null texts count as empty, and empty texts
    have a score like any other. Repeated rows get the same score; a null key is not held
    out. Without usable labels every score is a half; an empty table gives an empty result.
    """
    model = fit(docs, labels, key, text, label, max_rows)
    rows = docs.select(ref(key).alias("key"), ref(text).alias("text"))
    score = model.score(F.col("stats"))
    return with_statistics(rows, "text", "stats").select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, key: str = "doc_id",
    text: str = "text", label: str = "quality", cut: float = CUT, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``docs`` without the rows whose score is under ``cut``; see ``scores``.

    ``learn_from`` holds the labelled texts when these are not in ``docs`` itself.
    """
    model = fit(docs if learn_from is None else learn_from, labels, key, text, label, max_rows)
    column = fresh(docs, "__stats")
    scored = with_statistics(docs, text, column)
    return scored.filter(model.score(ref(column)) >= cut).select(*[ref(c) for c in docs.columns])


def crc_held_out(key) -> bool:
    """The rule of ``held_out`` for one key, for tests and callers outside Spark."""
    return zlib.crc32(str(key).encode()) % 5 == 0
