import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, ROWS, edge, empty, prose, stored

from millrace.llm import components, exact_dedup, simhash, suffix_dedup


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


@given(st.text(alphabet="ab \t\n\r\x0b\x0c\x1c　é"))
def test_normalise(t):
    assert exact_dedup.normalise(t.encode()) == norm(t).encode()


def test_cuckoo_index_matches_a_dictionary():
    index, plain = exact_dedup.CuckooIndex(buckets=4), {}
    keys = [hashlib.sha256(str(i % 700).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        if i % 7 == 3:
            assert index.delete(k) == (plain.pop(k, None) is not None)
        else:
            index.insert(k, i, i)
            plain[k] = (min(plain.get(k, (i, 0))[0], i), plain.get(k, (i, 0))[1] + 1)
    assert {e[0]: (e[1], e[3]) for e in index.entries()} == plain
    assert index.size == len(plain) and index.mask > 4
    assert index.find(hashlib.sha256(b"absent").digest()) is None


def test_cuckoo_index_with_equal_marks_grows_and_loses_nothing():
    index = exact_dedup.CuckooIndex(buckets=2)
    keys = [b"\x01\x00" + i.to_bytes(8, "little") + bytes(22) for i in range(64)]
    for i, k in enumerate(keys):
        index.insert(k, i, i)
    assert all(index.find(k)[1] == i for i, k in enumerate(keys))


def test_exact_copies(spark, tmp_path):
    docs = edge(spark, tmp_path)
    got = exact_dedup.exact_copies(docs).collect()
    assert len(got) == len(ROWS)
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[hashlib.sha256(norm(t).encode()).hexdigest()].append(i)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(groups.keys())
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.drop_exact_copies(empty(spark, tmp_path)).count() == 0


def fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                part[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (k, _) in enumerate(rows):
        r = find(i)
        if k is not None and (least[r] is None or k < least[r]):
            least[r] = k
    return [(k, f"{f:016x}", least[find(i)]) for i, ((k, _), f) in enumerate(zip(rows, fps))]


def near_rows():
    rows = list(ROWS)
    base = prose(1, 400).split()
    for k in range(60):
        w = list(base)
        w[k * 6] = f"x{k}"
        rows.append((100 + k, " ".join(w)))
    return rows


def key(t):
    return tuple((x is None, x) for x in t)


def test_near_copies(spark, tmp_path):
    rows = near_rows()
    docs = stored(spark, tmp_path, rows)
    got = simhash.near_copies(docs)
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()]
    want = brute_components(rows)
    assert sorted(found, key=key) == sorted(want, key=key)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == got.select("keep_row").distinct().count()
    assert simhash.drop_near_copies(empty(spark, tmp_path)).count() == 0


def test_near_copies_with_anchors_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", 3)
    rows = near_rows()
    got = simhash.near_copies(stored(spark, tmp_path, rows)).collect()
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(
        brute_components(rows), key=key
    )


def test_anchors_meet_for_every_close_pair():
    import numpy as np

    r = np.random.default_rng(3)
    x = r.integers(-(2**63), 2**63, 300)
    for _ in range(40):
        y = x.copy()
        for _ in range(3):
            y ^= np.left_shift(np.int64(1), r.integers(0, 64, len(x)))
        a, b = simhash.anchor_rows(x), simhash.anchor_rows(y)
        homes = {(c, f) for c, f, h in zip(*a) if h}
        cells = defaultdict(set)
        for c, f in zip(b[0], b[1]):
            cells[f].add(c)
        by = defaultdict(set)
        for c, f in homes:
            by[f].add(c)
        assert all(by[p] & cells[q] for p, q in zip(x, y))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (200, 201)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert got[201] == 200 and len(got) == 73
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(none).count() == 0


def brute_removed(rows, depth):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + depth] for t in raw for i in range(len(t) - depth + 1))
    out = []
    for (k, _), t in zip(rows, raw):
        gone = [False] * len(t)
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone[i : i + depth] = [True] * depth
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows():
    passage = prose(9, 60)
    rows = [r for r in ROWS if r[1] is not LONG and (r[1] or "") != LONG + " tail"]
    rows += [(50 + k, prose(20 + k, 40 + k) + passage[k : 330 - k] + prose(90 + k, 30)) for k in range(12)]
    rows += [(80, passage + "é" + passage), (81, prose(33, 800)), (82, prose(33, 800)[37:2900])]
    rows += [(83, "ab" * 500), (84, "x" * 199), (85, "x" * 200), (86, "y" * 201)]
    return rows


@pytest.mark.parametrize("step", [1 << 18, 300])
def test_removed(spark, tmp_path, monkeypatch, step):
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    rows = repeat_rows()
    got = suffix_dedup.removed(stored(spark, tmp_path, rows)).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found, key=key) == sorted(brute_removed(rows, 200), key=key)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert suffix_dedup.removed(empty(spark, tmp_path), keep=False).count() == 0


def test_removed_in_small_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    rows = repeat_rows()
    got = suffix_dedup.removed(stored(spark, tmp_path, rows), keep=False).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found, key=key) == sorted(brute_removed(rows, 200), key=key)


def test_cover_holds_a_shift_for_any_two_places():
    cover, n = suffix_dedup.COVER, suffix_dedup.PERIOD
    assert {(a - b) % n for a in cover for b in cover} == set(range(n))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50, unique=True))
def test_names_survive_the_way(values):
    import numpy as np

    a = np.array(sorted(values), np.uint64)
    assert (suffix_dedup._read(suffix_dedup._write(a), len(a), False)[0] == a).all()
