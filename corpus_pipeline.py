"""The corpus pipeline: stages over ``documents``, each stored and read again by the next."""

from __future__ import annotations

import public_tokenizers

from millrace.catalog.registry import table
from millrace.llm import bpe, decontaminate, exact_dedup, quality_rules, similar
from millrace.session import scratch, scratch_path


def quality(spark, docs, sf_dir):
    """Rows that the rule ensemble, learnt from ``labels``, accepts."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def exact(spark, docs, sf_dir):
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark, docs, sf_dir):
    """One row of each group of texts whose 5-word shingles have a Jaccard similarity of 0.8."""
    return similar.drop_similar(docs)


def decontaminated(spark, docs, sf_dir):
    """Rows without passages of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe.token_digests(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near-dedup by shingles", near),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", tokens),
]

#: The classifier, the near copies and the merges are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole ``documents`` table; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.split()[0].lower())
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
