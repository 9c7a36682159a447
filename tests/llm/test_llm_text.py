import base64
import hashlib
import re
import zlib

import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, ROWS, edge, empty, prose, stored
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, html_text, license_scan, pii, quality_rules, warc

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
REPLAY = bpe.MergeReplay(RANKS)
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SEPARATED = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def key(t):
    return tuple((x is None, x) for x in t)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# Byte-level BPE


def test_ranks_as_the_format_says():
    with open(PATH, "rb") as f:
        token, rank = f.readline().split()
    assert RANKS[base64.b64decode(token)] == int(rank)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=6))
def test_encoder_is_the_library(texts):
    encoder = bpe.Encoder(RANKS, P.PATTERN)
    got = [ids.tolist() for _ in range(2) for ids in encoder.encode(texts)]
    assert got == 2 * [TIKTOKEN.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aend ti", min_size=1, max_size=60), max_size=20))
def test_replay_of_runs_is_step_by_step(texts):
    raw = [t.encode() for t in texts]
    assert REPLAY.encode(raw) == [REPLAY.one(t) for t in raw]


def test_long_words():
    texts = ["a" * 40_000, "ab" * 20_000, " " * 30_000 + "x", "é" * 9_000, "=-" * 5_000]
    assert [REPLAY.one(t.encode()) for t in texts] == REPLAY.encode([t.encode() for t in texts])
    assert REPLAY.encode([b"na" * 500]) == [TIKTOKEN.encode_ordinary("na" * 500)]


def test_bpe_over_a_table(spark, tmp_path):
    docs = edge(spark, tmp_path)
    got = bpe.encode(docs, PATH, P.PATTERN)
    assert got.columns == [*docs.columns, "ids_"]
    back = bpe.decode(got, PATH, "ids_").select("doc_id", "text", "ids_", "decoded").collect()
    assert len(back) == len(ROWS)
    for r in back:
        assert r.ids_ == TIKTOKEN.encode_ordinary(r.text or "") and r.decoded == (r.text or "")
    digests = bpe.token_digests(docs, PATH, P.PATTERN).collect()
    want = []
    for i, t in ROWS:
        ids = TIKTOKEN.encode_ordinary(t or "")
        text = " ".join(map(str, ids)).encode()
        want.append((i, len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, digests), key=key) == sorted(want, key=key)
    assert bpe.token_digests(empty(spark, tmp_path), PATH, P.PATTERN).count() == 0


# Decontamination


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab ", min_size=1, max_size=9), min_size=1, max_size=8), st.text(alphabet="ab ", max_size=60))
def test_wu_manber(strings, text):
    strings = sorted({s.encode() for s in strings})
    raw = text.encode()
    found = sorted(x for t in decontaminate.searchers(strings) for x in t.scan(raw))
    want = sorted((i, s) for s in strings for i in range(len(raw)) if raw.startswith(s, i))
    assert found == want


def brute_contamination(docs, items):
    def words(t):
        return re.findall(SEPARATED, lower(t))

    wins = {}
    for i, t in items:
        w = words(t)
        name = "null" if i is None else str(i)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(name)
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                names = wins.get(tuple(w[k : k + n]))
                if names:
                    hit |= set(range(k, k + n))
                    found |= names
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [1 << 24, 1500])
def test_contamination(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    passage = prose(41, 30)
    items = [(1, passage), (2, "zig zag"), (None, prose(42, 14)), (4, None), (5, ""), (1, passage), (6, "w1"), (10, prose(43, 13))]
    rows = ROWS + [(60, "x " * 20 + passage[10:120].upper()), (61, prose(42, 14) + "!"), (62, "Zig, ZAG"), (63, "zigzag"),
                   (64, prose(43, 13) + " " + prose(44, 500)), (65, prose(41, 12))]
    bench = stored(spark, tmp_path, items, name="bench").withColumnRenamed("doc_id", "item_id")
    docs = stored(spark, tmp_path, rows)
    got = decontaminate.contamination(docs, bench).collect()
    found = [(r.doc_id, r.n_words, tuple(sorted(r.hit)), tuple(r["items"]), r.contaminated) for r in got]
    want = brute_contamination(rows, items)
    assert sorted(found, key=key) == sorted(want, key=key)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    nothing = empty(spark, tmp_path)
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, nothing.withColumnRenamed("doc_id", "item_id")).count() == len(rows)


# License scans


def brute_base(t):
    w = re.findall(SEPARATED, lower(t))
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark, tmp_path):
    mit = license_scan.TEMPLATES[0][1].split()
    cut = " ".join(mit[:20] + ["really", "truly"] + mit[20:])
    rows = ROWS + [
        (70, "Released under the MIT License. Under-the.MIT/license"), (71, "CC BY-NC 4.0 cc by nc cc"),
        (72, "Apache License, Version 2.0"), (73, "apache license version 20"), (74, "under the mit licensee"),
        (75, cut), (76, " ".join(mit[::-1])), (77, "under the"), (78, "éunder the mit license"),
        (79, "under the K mit license"), (80, prose(3, 50) + " " + " ".join(mit[:40])),
    ]
    got = license_scan.scan(stored(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows)
    found = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(found, key=key) == sorted([(i, *brute_base(t)) for i, t in rows], key=key)
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[70] == ("mit", 1.0) and labels[72] == ("apache-2", 1.0)
    assert labels[75][0] == "mit" and labels[80][0] == "mit" and 0.6 <= labels[80][1] < 1
    assert labels[76] == ("", 0.0) and labels[8] == ("", 0.0)
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert license_scan.scan(empty(spark, tmp_path)).count() == 0
    plan = license_scan.votes(edge(spark, tmp_path), "doc_id", "text")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Personal data


def brute_spans(t):
    t, out = t or "", []
    for k, rx in (("email", pii.EMAIL), ("ip", pii.IP), ("card", pii.CARD), ("phone", pii.PHONE)):
        for m in rx.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a@.-_%+1920 ()\n4é", max_size=60))
def test_base_spans(text):
    assert [s[:3] for s in pii.base_spans(text)] == brute_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_terms(spark, tmp_path):
    filler = [(100 + k, "\n".join(prose(200 + k, 12, 60) for _ in range(4))) for k in range(40)]
    told = [(150 + k, f"{prose(300 + k, 6, 60)} Zorvex writes as z.orvex@mail.example.org {prose(400 + k, 3, 60)}") for k in range(5)]
    rows = ROWS + filler + told + [
        (160, "Éa Zorvex came by"), (161, "call +49 (30) 1234567 or 10.0.0.255, 10.0.0.256; 4111 1111 1111 1111"),
        (162, "zorvexes are not zorvex1"),
    ]
    docs = stored(spark, tmp_path, rows)
    got = pii.spans(docs).collect()
    assert len(got) == len(rows)
    base = sorted(((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.base)) for r in got), key=key)
    assert base == sorted(((i, tuple(brute_spans(t))) for i, t in rows), key=key)
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in got if r.added}
    assert added[160] == [(3, 9)] and 162 not in added and not set(added) & set(range(100, 140))
    assert all(len(added[150 + k]) >= 1 for k in range(5))
    text = {r.doc_id: r.sanitised for r in pii.sanitise(docs).select("doc_id", "sanitised").collect()}
    assert text[160] in ("Éa [...] came by", "Éa [term] came by") and "[email]" in text[150] and text[100] == filler[0][1]
    assert text[161] == "call [phone] or [ip], 10.0.0.256; [card]" and text[2] is None
    assert pii.spans(empty(spark, tmp_path)).count() == 0
    spans = pii.spans(docs).filter("doc_id = 161").select(pii.span_text(pii.all_spans(F.col("base"), F.col("added"))))
    assert spans.first()[0].startswith("phone:5:")


def test_pii_shares_are_the_definition(spark, tmp_path):
    from collections import Counter
    from math import log2

    rows = [(k, f"tell quark{k % 2} a@b.{'cd'[k % 2]} now") for k in range(8)] + [(50, "quark0 alone\nnow now"), (51, "now")]
    rows = [(i, t + f" v{i}") for i, t in rows]
    docs = stored(spark, tmp_path, rows)
    got = {bytes(r.term).decode(): r.share for r in pii.disclosing_terms(docs.select("text")).collect()}
    lines = [x for _, t in rows for x in t.split("\n")]
    n, want = len(lines), {}
    entity = {e: {k for k, x in enumerate(lines) if e in x} for e in ("a@b.c", "a@b.d")}
    count = Counter(w for x in lines for w in set(x.split()))
    for e, at in entity.items():
        for w in {w for k in at for w in lines[k].split()} - {e, "a@b.c", "a@b.d"}:
            both = sum(w in lines[k].split() for k in at)
            if both >= pii.SUPPORT and len(w) >= 3:
                share = log2(n * both / (len(at) * count[w])) / log2(n / len(at))
                want[w] = max(share, want.get(w, 0))
    want = {w: s for w, s in want.items() if s >= pii.GENERALISE}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in got)


# Quality rules


def quality_rows():
    good = [(k, f"{prose(k, 60, 3000).capitalize()}.\n{prose(k + 5000, 30, 3000)}.") for k in range(300)]
    bad = [(1000 + k, " ".join(f"w{j}$$$" for j in range(k % 50 + 20))) for k in range(120)]
    return good, bad


def test_quality_rules(spark, tmp_path):
    good, bad = quality_rows()
    docs = stored(spark, tmp_path, ROWS + good + bad)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (5, None, 0), (999_999, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    got = quality_rules.scores(docs, labels)
    rows = got.collect()
    assert len(rows) == len(ROWS) + len(good) + len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    want = {i: 1 for i, _ in good} | {i: 0 for i, _ in bad}
    out = [(r.predicted, want[r.doc_id]) for r in rows if r.doc_id in want and r.held_out]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    none = labels.limit(0)
    assert {r.score for r in quality_rules.scores(docs, none).collect()} == {0.5}
    assert quality_rules.scores(empty(spark, tmp_path), none).count() == 0


def test_rules_compile_to_the_same_scores(spark):
    rule = quality_rules.simplified(((0, True, 3.0), (0, True, 2.0), (1, False, 0.5)))
    assert rule == ((0, True, 2.0), (1, False, 0.5))
    model = quality_rules.RuleEnsemble(0.0, [(rule, 2.0), (((1, True, 0.5),), -1.0)])
    df = spark.createDataFrame([([1.0, 1.0],), ([3.0, 1.0],), ([1.0, 0.5],)], "s array<double>")
    got = [r[0] for r in df.select(model.score(F.col("s"))).collect()]
    assert got == pytest.approx([1 / (1 + 2.718281828459045**-2), 0.5, 1 / (1 + 2.718281828459045)])


# WARC


PAGE_ROWS = [
    (1, "a" * 1500), (2, "a" * 1500), (9, "a" * 1500), (3, "short"), (4, "short"), (5, None), (6, ""),
    (7, "x\r\n\r\nWARC/1.1\r\ny\r\n\r\nWARC/1.1\r\n"), (8, "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (10, "\r\n\r\n" * 9), (11, "é\U0001f600" * 900), (12, LONG), (13, LONG), (13, LONG), (14, "end\r\n"), (15, "\r\n\r\nWARC/1.1\r\n"),
    (16, "\r\n\r\nWAR" + "C/1.1\r\n" * 300), (None, "a" * 1500), (None, None),
]


def brute_warc(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        same = [j for j, u in rows if (u or "") == (t or "")]
        last = max((j for j in same if j is not None), default=None)
        # The last stored one of rows with the same key answers.
        first = len(raw) < 1000 or (i == last and (i, t) not in rows[k + 1 :])
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first else "revisit", None if first else last))
    return out


@pytest.mark.parametrize("chunk,split", [(1 << 18, 1 << 27), (37, 700)])
def test_warc(spark, tmp_path, chunk, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = stored(spark, tmp_path, PAGE_ROWS, name="pages").withColumnRenamed("doc_id", "page_id")
    pages = pages.withColumnRenamed("ids", "url").withColumnRenamed("text", "html")
    pages.withColumn("url", F.expr("if(page_id % 2 = 0, null, concat('http://x/', page_id, '\r\nWARC-Type: bad'))")).write.parquet(
        str(tmp_path / "pages2")
    )
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = warc.round_trip(spark.read.parquet(str(tmp_path / "pages2")), chunk=chunk).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, got), key=key) == sorted(brute_warc(PAGE_ROWS), key=key)


def test_warc_file_is_one_a_parser_reads(spark, tmp_path):
    rows = [(i, t) for i, t in PAGE_ROWS if i is not None and i < 12]
    pages = stored(spark, tmp_path, rows, name="p").toDF("page_id", "html", "url", "b", "c", "d")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "out"), chunk=100)
    (file,) = (tmp_path / "out").glob("part-*")
    raw, at, parts = file.read_bytes(), 0, {}
    while at < len(raw):
        assert raw.startswith(b"WARC/1.1\r\n", at)
        end = raw.index(b"\r\n\r\n", at)
        head = dict(x.split(b": ", 1) for x in raw[at:end].split(b"\r\n")[1:])
        size = int(head[b"Content-Length"])
        block = raw[end + 4 : end + 4 + size]
        assert raw[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        at = end + 8 + size
        origin = head.get(b"WARC-Segment-Origin-ID", head[b"WARC-Record-ID"])
        parts.setdefault((origin, head.get(b"X-Key")), []).append((int(head.get(b"WARC-Segment-Number", 1)), block, head[b"WARC-Type"]))
    want = {str(i).encode(): (t or "").encode() for i, t in rows}
    for (_, k), p in parts.items():
        if p[0][2] != b"revisit":
            assert b"".join(b for _, b, _ in sorted(p)) == want[k]


def test_warc_of_an_empty_table(spark, tmp_path):
    pages = empty(spark, tmp_path).toDF("page_id", "html", "url", "b", "c", "d")
    assert warc.round_trip(pages).count() == 0


# HTML


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("a<b>b</b>c <i> d</i>", "abc d"),
        ("<table>loose<tr><td>a</table>", "loose\n\na"),
        ("<title>t</title><script>x<y</script><style>p{}</style>v", "v"),
        ("<head><meta charset=x><title>t</title></head><body>v</body>", "v"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
        ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
        ("<p hidden>n</p><p style='DISPLAY : none'>n</p><p>y", "y"),
        ("<noscript>n</noscript><textarea>n</textarea><template>n</template>y", "y"),
        ("<table><tr><th>a<th>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><tr><td>a</td><td>b</td></tr></table>after", "a  b\n\nafter"),
        ("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>", "x     y\n\n1  2"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("a<br>b", "a\nb"),
        ("a<!-- x > y -->b<!-- open", "ab"),
        ("a < b <3 c", "a < b <3 c"),
        ("<p title='a>b'>t</p>", "t"),
        ("<b><p>x</b>y</p>", "x\ny"),
        ("<h1>H</h1>t<h2>I</h2>", "H\n\nt\n\nI"),
        ("x<p", "x"),
    ],
)
def test_visible_text(page, text):
    got = html_text.visible_text(page)
    if page.startswith(("<b><p>", "<table><tr><td>x<table>")):
        assert re.sub(r"\s+", "", got) == re.sub(r"\s+", "", text)
    else:
        assert got == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <td> <tr> <table> </table> <li> <ul> </ul> <b> </b> <pre> <br> x y & <!-- --> < > <div </div> <script> \" '".split() + [" ", "\n"]), max_size=40))
def test_any_markup_has_a_text(parts):
    html_text.visible_text("".join(parts))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "<p>", "<li>", "<b>", "<tr>", "<td>", "</p>", "</div>", "<table>", "</table>", "<ul>"]), max_size=30))
def test_no_visible_word_is_lost(tags):
    page = "".join(f"{t}w{k}" for k, t in enumerate(tags))
    got = html_text.visible_text(page)
    assert sorted(re.findall(r"w\d+", got)) == sorted(f"w{k}" for k in range(len(tags)))


def test_deep_nesting():
    assert html_text.visible_text("<div>" * 20_000 + "x") == "x"
    assert "x" in html_text.visible_text("<table><tr><td>" * 300 + "x")


def test_extract(spark, tmp_path):
    pages = stored(spark, tmp_path, [(1, "<p>a<p>b"), (None, None), (3, ""), (3, "")]).toDF(
        "page_id", "html", "content", "b", "c", "d"
    )
    got = html_text.extract(pages)
    assert got.columns == [*pages.columns, "content_"]
    rows = sorted(map(tuple, html_text.extracted(pages).collect()), key=key)
    blank = hashlib.sha256(b"").hexdigest()
    assert rows == [(1, 3, 4, hashlib.sha256(b"a\n\nb").hexdigest(), "a\n\nb"), *[(3, 0, 0, blank, "")] * 2, (None, 0, 0, blank, "")]
    assert html_text.extracted(pages.limit(0)).count() == 0
