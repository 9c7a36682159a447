"""The pipeline against a brute-force version of it; only the fitted classifier is taken as given."""

import hashlib
import re
import shutil

import public_tokenizers as P
import tiktoken
from llm_cases import ROWS, prose, stored
from test_llm_text import brute_contamination

import corpus_pipeline
from millrace.llm import bpe, quality_rules, similar


def shingles(t):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = [x for x in re.split("[ \t\n\r\x0b\x0c]+", w) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows):
    """Rows ``(id, text)`` that stay: the smallest id of each component."""
    sets, part = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 10 * len(a & b) >= 8 * len(a | b) > 0:
                part[find(i)] = find(j)
    best = {}
    for i, (k, t) in enumerate(rows):
        r = find(i)
        if r not in best or (k is None, k) < (best[r][0] is None, best[r][0]):
            best[r] = (k, t)
    return list(best.values())


def changed(t, every):
    w = t.split()
    return " ".join("zzz" if k % every == every // 2 else x for k, x in enumerate(w))


def test_drop_similar(spark, tmp_path):
    base = prose(1, 400)
    # A few changes are similar to the base, many are not; the cuts are a chain joined link by link.
    rows = ROWS + [(100, base), (101, changed(base, 60)), (102, changed(base, 12)), (103, base.upper())]
    rows += [(110 + k, " ".join(base.split()[k * 15 : 250 + k * 15])) for k in range(9)]
    rows += [(200 + k, prose(9, 300) + " " + prose(50 + k, 30 + 5 * k)) for k in range(12)] + [(300, "a b c"), (301, "A  B c")]
    docs = stored(spark, tmp_path, rows)
    kept = similar.drop_similar(docs)
    assert kept.columns == docs.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    assert got == sorted(str(k) for k, _ in brute_near(rows))
    assert similar.drop_similar(docs.limit(0)).count() == 0


def test_members_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similar, "MEMBERS", 3)
    base = prose(1, 400)
    rows = [(k, changed(base, 101 + k)) for k in range(30)]
    got = similar.drop_similar(stored(spark, tmp_path, rows)).collect()
    assert [r.doc_id for r in got] == [k for k, _ in brute_near(rows)] == [0]


def test_pipeline_is_the_brute_force_one(spark, sf_dir, tmp_path):
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in source.select("doc_id", "text").collect()]
    planted = [(10_000_000 + i, changed(t, 60)) for i, t in rows if len(t.split()) > 100]
    extra = spark.createDataFrame(planted, "doc_id bigint, text string")
    path = str(tmp_path / "documents.parquet")
    source.unionByName(extra, allowMissingColumns=True).coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    good = [(r.doc_id, r.text) for r in quality_rules.keep_good(docs, labels, docs).select("doc_id", "text").collect()]
    exact = {}
    for i, t in sorted(good):
        exact.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    near = brute_near(list(exact.values()))
    assert len(near) < len(exact) - 20
    items = [(r.item_id, r.text) for r in spark.read.parquet(str(tmp_path / "benchmark.parquet")).collect()]
    bad = {x[0] for x in brute_contamination(near, items) if x[-1]}
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in near:
        if i not in bad:
            ids = own.encode_ordinary(t)
            digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            want.append((i, len(ids), digest, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(want)
