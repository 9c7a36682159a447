"""The operators over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from millrace.catalog.registry import table
from millrace.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_text,
    license_scan,
    periodic,
    pii,
    quality_rules,
    secrets,
    simhash,
    suffix_dedup,
    warc,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op3_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
         b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
         windows AS (
             SELECT DISTINCT item, list_slice(w, i, i + 12) AS win
             FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
         lens AS (SELECT DISTINCT len(win) AS n FROM windows),
         grams AS (
             SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
             FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
         found AS (SELECT doc_id, i, n, item FROM grams JOIN windows USING (win)),
         hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                 FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
         items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op3(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


@query(
    "op5_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                      AS text_sha256 FROM documents),
         g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
)
def op5(spark, sf_dir):
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents")).drop("__row")


@query("op8_byte_bpe")
def op8(spark, sf_dir):
    return bpe.token_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )


@query("op10_simhash")
def op10(spark, sf_dir):
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query("op9_quality_rules")
def op9(spark, sf_dir):
    return quality_rules.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_suffix_dedup")
def op7(spark, sf_dir):
    return suffix_dedup.removed(table(spark, sf_dir, "documents"), keep=False)


@query("op1_license_scan")
def op1(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op2_pii")
def op2(spark, sf_dir):
    found = pii.spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS[:4]],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(pii.all_spans(F.col("base"), F.col("added"))).alias("spans"),
    )


@query(
    "op4_warc",
    """
    WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n
               FROM pages),
         t AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM p)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
    FROM t""",
)
def op4(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op6_html_text")
def op6(spark, sf_dir):
    return html_text.extracted(table(spark, sf_dir, "pages"))


def planted(docs):
    """``documents`` of which a tenth, by the checksum of the id, ends in a period of its own."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    w = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    split = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, w).alias("w"))
    n = F.size("w")
    start = split.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    period = (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")
    unit = F.slice("w", F.col("a") + 1, F.col("p"))
    copies = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    told = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), copies), " ")
    return start.withColumn("p", period).select("doc_id", F.when(F.col("n") > 0, told).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    found = periodic.repeats(planted(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = periodic.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_hard_negatives",
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS anchor_id, a.label AS own, v.vec_id, v.label,
                      CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
               FROM v AS a JOIN v ON a.vec_id % 100 = 0),
         p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score
               FROM s WHERE label = own AND vec_id <> anchor_id
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10""",
)
def op12(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), lambda key: key % 100 == 0)


@query("op13_secret_scan")
def op13(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(secrets.all_spans(F.col("base"), F.col("added"))).alias("spans"),
    )
