"""WARC archives written and read as tables of record chunks.

A payload longer than ``CHUNK`` characters becomes several records, numbered segments of one
logical record, so nothing that is written or read back is larger than a chunk. Records are
rows of Spark's text format: a row is the header and the block, the line separator is the
two line ends that close a record. A payload that holds the version text that starts a record
is also cut inside it, so archives split cleanly at ``BETWEEN`` and can be read in parallel
from any offset. Every chunk carries its own digest, so that a damaged one is known by itself.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.session import materialize, scratch_path

CHUNK = 1 << 18
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1_000

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n"
BETWEEN = END + END + VERSION + END
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunks(payload: Column, size: int = CHUNK) -> Column:
    """The payload cut into pieces of at most ``size`` characters, none of which holds the
    version text that starts a record, with or without a line end behind: what closes a record
    would complete it. An empty payload is one empty piece."""
    whole = ~payload.contains(VERSION) & (F.length(payload) <= size)
    # The cut falls into the version text: neither side holds it whole.
    cut = F.split(payload, r"(?<=WAR)(?=C/1\.1)")
    pieces = F.flatten(F.transform(cut, lambda p: F.regexp_extract_all(p, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))))
    return F.when(whole, F.array(payload)).otherwise(pieces)


def plan_records(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Rows with ``__row``, key, url, payload, ``digest``, ``bytes`` and ``target``: the row
    whose payload a revisit repeats, null for responses."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("__row"), ref(key).alias("key"),
        F.coalesce(ref(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(ref(payload).cast("string"), F.lit("")).alias("payload"),
    )
    marks = materialize(
        rows.select("__row", "key", F.sha1(F.col("payload").cast("binary")).alias("digest"),
                    F.octet_length("payload").cast("bigint").alias("bytes")), "payload-digests",
    )
    long = marks.filter(F.col("bytes") >= REVISIT_BYTES)
    groups = (
        long.groupBy("digest", "bytes")
        .agg(F.count("*").alias("n"), F.max(F.struct("key", "__row")).alias("last"))
        .filter("n > 1").select("digest", "bytes", F.col("last.__row").alias("target"))
    )
    again = long.join(groups, ["digest", "bytes"]).filter("__row <> target").select("__row", "target")
    # Only revisits are joined. Stored, so that Spark knows their size: a short list goes to the
    # payloads, beyond Spark's own limit the payloads are shuffled.
    known = rows.withColumns(
        {"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload").cast("bigint")}
    )
    return known.join(materialize(again, "revisits"), "__row", "left")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "2000-01-01T00:00:00Z", chunk: int = CHUNK,
) -> None:
    """One logical record for each row of ``pages``; see ``round_trip`` for the rules."""
    rows = plan_records(pages, key, url, payload)
    revisit = F.col("target").isNotNull()
    pieces = F.when(revisit, F.array(F.lit(""))).otherwise(chunks(F.col("payload"), chunk))
    parts = rows.withColumn("n", F.size(pieces)).select("*", F.posexplode(pieces).alias("at", "piece"))
    number = lambda c: F.concat(F.lit("<urn:record:"), c.cast("string"), F.lit(">"))
    first = F.col("at") == 0

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(name + ": "), value.cast("string"), F.lit(END))
        return text if when is None else F.when(when, text).otherwise("")

    own = F.concat_ws(".", F.col("__row").cast("string"), F.when(~first, F.col("at").cast("string")))
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")
    record = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", kind),
        line("WARC-Record-ID", number(own)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " "), F.col("url") != ""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("X-Key", F.col("key"), F.col("key").isNotNull()),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), revisit),
        line("WARC-Refers-To", number(F.col("target")), revisit),
        line("WARC-Segment-Number", F.col("at") + 1, F.col("n") > 1),
        line("WARC-Segment-Origin-ID", number(F.col("__row")), ~first),
        line("WARC-Segment-Total-Length", F.col("bytes"), F.col("at") + 1 == F.col("n")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("piece").cast("binary")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.octet_length("piece").cast("string"), F.lit(END + END),
        F.col("piece"),
    )
    parts.select(record.alias("value")).write.option("lineSep", END + END).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The record chunks of archives: ``record``, ``chunk`` (from 0), ``type`` (of the logical
    record), ``key``, ``refers_to``, ``more`` (further chunks follow or came before), ``block``,
    ``block_digest`` as written and ``intact``, whether the block still has it."""
    raw = spark.read.option("lineSep", BETWEEN).text(path)
    start = VERSION + END
    value = F.when(F.col("value").startswith(start), F.expr(f"substring(value, {len(start) + 1})")).otherwise(
        F.col("value")
    )
    head = F.substring_index("value", END + END, 1)
    fields = raw.select(value.alias("value")).select("value", head.alias("head")).select(
        F.str_to_map("head", F.lit(END), F.lit(": ")).alias("h"),
        F.expr("substring(value, length(head) + 5)").cast("binary").alias("rest"),
    )
    name = lambda c: F.regexp_extract(F.coalesce(c, F.lit("")), r"^<urn:record:(\d+)", 1)
    h = F.col("h")
    size = h["Content-Length"].cast("int")
    segment = h["WARC-Segment-Number"].cast("bigint")
    block = F.substring(F.col("rest"), F.lit(1), size)
    written = F.regexp_replace(h["WARC-Block-Digest"], "^sha1:", "")
    return fields.select(
        name(F.coalesce(h["WARC-Segment-Origin-ID"], h["WARC-Record-ID"])).cast("bigint").alias("record"),
        F.coalesce(segment - 1, F.lit(0)).alias("chunk"),
        F.when(h["WARC-Type"] == "continuation", "response").otherwise(h["WARC-Type"]).alias("type"),
        h["X-Key"].alias("key"),
        F.nullif(name(h["WARC-Refers-To"]), F.lit("")).cast("bigint").alias("refers_to"),
        segment.isNotNull().alias("more"),
        block.alias("block"),
        written.alias("block_digest"),
        (F.sha1(block) == written).alias("intact"),
    )


def payload_digests(parts: DataFrame) -> DataFrame:
    """Length and SHA-1 of each logical record's payload, chunk after chunk.

    Records of one chunk are summed up where they are. The chunks of longer records are
    brought together in order and fed to a running digest; a task holds one chunk of one
    record at a time.
    """
    named = ["record", "type", "key", "refers_to"]
    single = parts.filter("not more").select(
        *named, F.octet_length("block").cast("bigint").alias("bytes"), F.sha1("block").alias("digest")
    )

    def chain(batches):
        last, row, total, run = None, None, 0, None

        def done():
            return pa.RecordBatch.from_pylist([{**row, "bytes": total, "digest": run.hexdigest()}], schema)

        schema = pa.schema(
            [("record", pa.int64()), ("type", pa.string()), ("key", pa.string()), ("refers_to", pa.int64()),
             ("bytes", pa.int64()), ("digest", pa.string())]
        )
        for batch in batches:
            for i in range(batch.num_rows):
                record = batch.column(0)[i].as_py()
                if record != last:
                    if last is not None:
                        yield done()
                    last, total, run = record, 0, hashlib.sha1()
                    row = {c: batch.column(j)[i].as_py() for j, c in enumerate(named)}
                block = batch.column(5)[i].as_py()
                run.update(block)
                total += len(block)
        if last is not None:
            yield done()

    long = (
        parts.filter("more").select(*named, "chunk", "block")
        .repartition("record").sortWithinPartitions("record", "chunk")
        .mapInArrow(chain, "record bigint, type string, key string, refers_to bigint, bytes bigint, digest string")
    )
    return single.unionByName(long)


def round_trip(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    path: str | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """Write archives for ``pages`` to ``path`` and give what they hold, one row per record:
    key, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Null payloads are empty ones. Of equal payloads of at least ``REVISIT_BYTES`` bytes the
    row with the largest key is the response (a null key is the smallest; of rows with the
    same key, the last stored one), the others are revisits without a block, and refer to
    it. Repeated rows are records of their own. A null url is left out of the header. An
    empty table gives archives without records and an empty result. ``pages`` must be a
    stored table; its other columns are not looked at.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, key, url, payload, chunk=chunk)
    found = materialize(payload_digests(read_chunks(spark, path)), "warc-records")
    kind = pages.select(ref(key)).schema[0].dataType
    answers = found.filter("type = 'response'")
    targets = answers.select(
        F.col("record").alias("refers_to"), F.col("key").alias("to"),
        F.col("bytes").alias("b"), F.col("digest").alias("d"),
    )
    revisits = found.filter("type = 'revisit'").join(targets, "refers_to").select("key", "b", "d", "type", "to")
    both = answers.select("key", "bytes", "digest", "type", F.lit(None).cast("string").alias("to")).union(revisits)
    return both.select(
        F.col("key").cast(kind).alias(key), F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("to").cast(kind).alias("refers_to"),
    )
