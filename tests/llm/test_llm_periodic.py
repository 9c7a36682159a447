import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ROWS, edge, empty, prose, stored

from millrace.llm import periodic, queries


def brute(words):
    """All runs: the smallest period of every stretch that no neighbouring word extends."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def ids(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_runs_match_brute_force(data):
    words = []
    for _ in range(data.draw(st.integers(1, 4))):
        unit = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 3))), min_size=1, max_size=90))
        times = data.draw(st.integers(1, 7))
        cut = data.draw(st.integers(0, len(unit)))
        words += (unit * times)[: len(unit) * times - cut]
        words += data.draw(st.lists(st.integers(0, 5), max_size=12))
    assert periodic.find_runs(ids(words)) == brute(words)


def test_every_period_is_found_at_exactly_three_periods():
    r = random.Random(3)
    for q in [*range(1, 140), 199, 200, 431, 1000]:
        unit = [r.randrange(3) for _ in range(q - 1)] + [9]
        words = [7, 8] + (unit * max(3, -(-24 // q)))[: max(24, 3 * q)] + [10, 11]
        assert (2, 2 + max(24, 3 * q), q) in periodic.find_runs(ids(words))


def test_long_scales_and_laid_out_texts():
    r = random.Random(4)
    unit = [r.randrange(50) for _ in range(7_000)]
    texts = [b" ".join(b"%d" % x for x in t) for t in (unit * 3, [1] * 24, [1] * 23, [], unit[:40] * 5)]
    split, numbers, starts = periodic.numbered(texts)
    found = periodic.find_runs(numbers, max(map(len, split)))
    assert found == [(0, 21_000, 7_000), (21_001, 21_025, 1), (int(starts[4]), int(starts[4]) + 200, 40)]


def collapsed(words, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_with_runs():
    line = " ".join(f"l{i}" for i in range(30))
    return [
        *ROWS, (20, "a b c " * 9), (20, "a b c " * 9), (21, (line + "\n") * 4), (22, "x " * 23), (23, "x " * 24),
        (24, prose(1, 50) + " " + (line + " ") * 3 + "u v " * 13 + prose(2, 20)),
    ]


def test_repeats_and_collapse(spark, tmp_path):
    rows = texts_with_runs()
    docs = stored(spark, tmp_path, rows)
    got = periodic.repeats(docs).collect()
    want = []
    for key, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute(words) if len(words) < 5_000 else []
        want.append((key, len(words), [(s, e - s, q) for s, e, q in runs], collapsed(words, runs)))
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=order) == sorted(want, key=order)
    short = periodic.collapse(docs)
    assert short.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text or "") for r in short.collect())
    assert texts == sorted((k or 0, c if runs else t or "") for (k, t), (_, _, runs, c) in zip(rows, want))
    assert periodic.repeats(empty(spark, tmp_path)).count() == 0


def test_query_matches_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op11(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words) if n < 4_000 else [(s, e, q) for s, e, q in periodic.find_runs(ids(words))]
        some += bool(runs)
        r = got[doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            best = min(runs, key=lambda x: (-(x[1] - x[0]) / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period) == (best[0], best[1] - best[0], best[2])
            assert r.exponent_milli == 1000 * r.length // r.period
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None, None, None, None)
    assert some > 5
