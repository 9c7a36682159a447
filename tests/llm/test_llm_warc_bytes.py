"""Every byte comes back, whatever the payload has in common with what parts records."""

import hashlib
import random

import pytest
from llm_cases import prose

from millrace.llm import warc

PIECES = ["\r\n", "\r", "\n", "WARC/1.1", "WARC/1.1\r\n", "WAR", "C/1.1", "a", "é", "\r\n\r\nWARC/1.1", "Content-Length: 3"]


def payloads():
    r = random.Random(7)
    fixed = ["abc\r\n\r\nWARC/1.1", "WARC/1.1", "\r\n\r\nWARC/1.1\r\n", "x" * 12 + "\r\n\r\nWARC/1.1" + "y" * 9, "", "WARC/1.1" * 300]
    drawn = ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    # Cut by size right behind the version text.
    return fixed + drawn + ["z" * k + "\r\n\r\nWARC/1.1" + prose(k, 30) for k in range(30)]


@pytest.mark.parametrize("chunk", [1 << 18, 24, 7])
def test_every_byte_comes_back(spark, tmp_path, chunk):
    rows = [(i, f"http://a/{i}", t) for i, t in enumerate(payloads())]
    path, archives = str(tmp_path / "pages"), str(tmp_path / "warc")
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(path)
    got = {r.page_id: r for r in warc.round_trip(spark.read.parquet(path), path=archives, chunk=chunk).collect()}
    assert len(got) == len(rows)
    for i, _, t in rows:
        raw = t.encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest()), t
    parts = warc.read_chunks(spark, archives)
    assert parts.filter("not intact or intact is null").count() == 0
    for r in parts.limit(50).collect():
        assert r.block_digest == hashlib.sha1(bytes(r.block)).hexdigest()
