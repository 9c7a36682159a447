"""The steps of the near-copy search: fingerprints, and how texts are sent to those they are compared with."""

import numpy as np
from llm_cases import LONG, prose, stored
from test_llm_pipeline import brute_near, changed

from millrace.llm import similar
from millrace.session import materialize


def test_fingerprints_find_near_copies_without_bands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similar, "bands", lambda s: [])
    words = LONG.split()
    rows = [(1, LONG), (2, LONG + " tail"), (3, " ".join(words[:-9])), (4, prose(77, 300)), (5, ""), (6, "x")]
    prints = [similar.fingerprint(similar.shingle_set(t.encode())) for _, t in rows[:3]]
    assert max(int(np.bitwise_count(prints[0] ^ p)) for p in prints) <= 3
    got = similar.drop_similar(stored(spark, tmp_path, rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 4, 5, 6]


def test_homes_of_a_band_are_dealt_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similar, "HOMES", 4)
    # Groups of texts that share bands without being similar: none is joined to another.
    rows = [(100 * g + k, prose(g, 200, 5_000) + " " + prose(1_000 + 100 * g + k, 90, 5_000)) for g in range(8) for k in range(16)]
    docs = stored(spark, tmp_path, rows)
    seen = []
    compared = similar.compared

    def counted(laid, *rest):
        laid = materialize(laid, "laid")
        seen.append(laid.groupBy("fp").count().selectExpr("avg(count)", "max(count)").first())
        return compared(laid, *rest)

    monkeypatch.setattr(similar, "compared", counted)
    got = sorted(r.doc_id for r in similar.drop_similar(docs).collect())
    assert got == sorted(k for k, _ in brute_near(rows)) and len(got) > 100
    # Dealt by chance, a text went to 9.2 parts on average.
    assert seen[0][0] < 6


def test_links_reach_all_similar_texts_whatever_the_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similar, "HOMES", 2)
    base = prose(3, 300)
    rows = [(k, changed(base, 40 + k)) for k in range(25)] + [(50 + k, prose(60 + k, 40)) for k in range(5)]
    got = sorted(r.doc_id for r in similar.drop_similar(stored(spark, tmp_path, rows)).collect())
    assert got == sorted(k for k, _ in brute_near(rows))
