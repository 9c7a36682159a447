"""License texts in documents, found by votes of word k-grams on diagonals.

Every run of three words of a document is joined, by its hash, to the places where the
templates have it. Document place less template place is the diagonal: words that stand in
the order of a template vote for one diagonal, and words added or left out move the rest to
a neighbouring one. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize

GRAM = 3
#: Neighbouring diagonals at most so many words apart are one span.
SLACK = 6
#: Share of a template's k-grams that a span must hold to carry its label.
COVER = 0.6

# Phrases and the labels they give wherever their words stand in a row.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of well-known license texts and notices, and their labels.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software "
             "foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software "
             "foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
              "the mpl was not distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted provided that the above copyright notice and this permission notice appear in "
            "all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring "
            "rights to this work"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
]

TEMPLATES += [
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
]
_NC, _SA = ("noncommercial", "non commercial"), ("sharealike", "share alike")
_ND = ("noderivatives", "noderivs", "no derivatives", "no derivs")
_TERMS = [("nc", x) for x in _NC] + [("sa", x) for x in _SA] + [("nd", x) for x in _ND]
_TERMS += [("nc-sa", f"{x} {y}") for x in _NC for y in _SA] + [("nc-nd", f"{x} {y}") for x in _NC for y in _ND]
TEMPLATES += [
    (f"cc-by-{kind}", f"this work is licensed under a creative commons attribution {terms} 4 0 international license")
    for kind, terms in _TERMS
]

# Words in a row that tell a label from its neighbours; a span must hold a
# k-gram with one of those that its template has.
DECIDING = {
    "apache-2": ["version 2"],
    "gpl": ["gnu general"],
    "lgpl": ["lesser general"],
    "agpl": ["affero general"],
    "cc-by-nc": ["by nc"],
    "cc-by-sa": ["by sa"],
}
for _kind, _terms in _TERMS:
    DECIDING.setdefault(f"cc-by-{_kind}", []).append(" ".join(f"attribution {_terms}".split()[-2:]))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per template and k-gram place, and one for the empty gram, template -1.

    As many rows as the fixed texts above have words, so it may be sent to every task.
    """
    texts = [(label, text, True) for text, label in PHRASES.items()]
    texts += [(label, text, False) for label, text in TEMPLATES]
    rows = [(-1, "", False, 1, 0, "", "", "", True)]
    for t, (label, text, base) in enumerate(texts):
        w = text.split()
        n = len(w) - GRAM + 1
        grams = [" ".join(w[k : k + GRAM]) for k in range(n)]
        decide = [any(f" {x} " in f" {g} " for x in DECIDING.get(label, ())) for g in grams]
        free = not any(decide)
        rows += [(t, label, base, n, k, *w[k : k + GRAM], free or decide[k]) for k in range(n)]
    grams = spark.createDataFrame(
        rows, "template int, label string, base boolean, grams int, place int, a string, b string, c string, "
        "decides boolean"
    )
    return grams.withColumn("h", F.xxhash64("a", "b", "c"))


def document_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(low, _GAP), lambda w: w != "")


def votes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document row, template and diagonal: the template places that voted.

    Every text ends in an empty gram, which meets template -1 on the diagonal that is its
    number of words; so each row of ``docs`` is in the result, text or no text.
    """
    blank = F.array(F.lit(""), F.lit(""), F.lit(""))
    framed = docs.select(
        F.monotonically_increasing_id().alias("__row"), ref(key).alias("doc_id"),
        F.concat(document_words(ref(text)), blank).alias("w"),
    )
    n = F.size("w")
    zipped = F.arrays_zip(
        F.col("w").alias("a"),
        F.slice("w", F.lit(2), n).alias("b"),
        F.slice("w", F.lit(3), n).alias("c"),
    )
    grams = framed.select("__row", "doc_id", F.posexplode(zipped).alias("at", "g")).select(
        "__row", "doc_id", "at", "g", F.xxhash64("g.a", "g.b", "g.c").alias("h")
    )
    known = F.broadcast(template_grams(docs.sparkSession))
    # The words themselves decide, so two grams of one hash do no harm.
    met = grams.join(known, "h").filter("g.a = a and g.b = b and g.c = c")
    return met.groupBy(
        "__row", "doc_id", "template", "label", "base", "grams", (F.col("at") - F.col("place")).alias("diagonal")
    ).agg(F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last"),
          F.max("decides").alias("decided"))


def spans(found: DataFrame) -> DataFrame:
    """Neighbouring diagonals of ``votes`` merged: ``start``, ``words``, ``decided`` (whether
    the deciding words are there) and ``cover``, the share of the template's k-grams that
    the span holds."""
    by = W.partitionBy("__row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(by)
    marked = found.withColumn("new", F.coalesce((step > SLACK).cast("int"), F.lit(1)))
    numbered = marked.withColumn("span", F.sum("new").over(by))
    merged = numbered.groupBy("__row", "template", "label", "grams", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held"),
        F.min("first").alias("start"), (F.max("last") - F.min("first") + GRAM).alias("words"),
        F.max("decided").alias("decided"),
    )
    return merged.withColumn("cover", F.col("held") / F.col("grams"))


def best(near: DataFrame) -> DataFrame:
    """``near`` without spans that lie by half or more under one of another label with a larger share."""
    spans_of = F.collect_list(F.struct("label", "start", "words", "cover")).over(W.partitionBy("__row"))
    end = lambda s: s["start"] + s["words"]
    mine = F.struct("label", "start", "words", "cover")
    under = lambda s: (
        (s["label"] != mine["label"]) & (s["cover"] > mine["cover"])
        & (2 * (F.least(end(s), end(mine)) - F.greatest(s["start"], mine["start"])) >= F.least(s["words"], mine["words"]))
    )
    return near.withColumn("__all", spans_of).filter(~F.exists("__all", under)).drop("__all")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_words``, ``n_base`` (places where a phrase of ``PHRASES`` stands),
    ``first_word``, ``last_word`` (smallest and largest start of these, from 0, else null),
    ``base_labels``, ``labels`` and ``score``.

    ``labels`` adds to the base labels those of templates of which a span holds at least
    ``COVER`` of the k-grams and its deciding words, spread over at most twice the template's
    words; of spans of several labels at one place the best covered one counts. ``score`` is
    the largest such share, 1 where a phrase stands, 0 without any vote. Null and empty
    texts have no words, no labels and score 0; repeated rows give repeated results; an
    empty table gives none. Other columns are not looked at. The words of one text must fit
    into a task's memory.
    """
    found = materialize(votes(docs, key, text), "votes")
    frame = found.filter("template = -1").select("__row", "doc_id", F.col("diagonal").cast("bigint").alias("n_words"))
    whole = F.col("base") & (F.size("places") == F.col("grams"))
    base = found.filter(whole).select(
        "__row", "label", F.col("diagonal").cast("bigint").alias("start"), F.lit(1.0).alias("cover")
    )
    near = spans(found.filter("template >= 0 and not base")).filter(
        F.col("decided") & (F.col("cover") >= COVER) & (F.col("words") <= 2 * (F.col("grams") + GRAM - 1))
    )
    near = best(near)
    rows = reduce(
        DataFrame.unionByName,
        [
            frame.select("__row", "doc_id", "n_words", *_none("start", "base_label", "label", "cover")),
            base.select("__row", *_none("doc_id", "n_words"), "start", F.col("label").alias("base_label"),
                        "label", "cover"),
            near.select("__row", *_none("doc_id", "n_words", "start", "base_label"), "label", "cover"),
        ],
    )
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    return rows.groupBy("__row").agg(
        F.max("doc_id").alias(key), F.max("n_words").alias("n_words"), F.count("start").alias("n_base"),
        F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        joined("base_label").alias("base_labels"), joined("label").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
    ).drop("__row")


def _none(*names: str) -> list[Column]:
    return [F.lit(None).alias(c) for c in names]
