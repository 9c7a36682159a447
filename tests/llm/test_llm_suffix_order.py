"""Names are put in order by their 64-bit part, and by both parts only where that does not do."""

import numpy as np
import pytest

from millrace.llm import suffix_dedup as S


def pairs(a, b):
    out = np.empty(len(a), [("a", "<u8"), ("b", "<u4")])
    out["a"], out["b"] = a, b
    return out


@pytest.mark.parametrize("values", [1 << 40, 50])
def test_ranks_of_pairs(values):
    r = np.random.default_rng(values)
    names = pairs(r.integers(0, values, 5_000), r.integers(0, 3, 5_000))
    names = np.concatenate([names, names[:700]])
    distinct, rank, count = S._ranked(names)
    want, inverse, n = np.unique(names, return_inverse=True, return_counts=True)
    assert (distinct == want).all() and (rank == inverse).all() and (count == n).all()


def test_pairs_are_sorted_by_one_part_when_that_does(monkeypatch):
    names = pairs(np.repeat(np.arange(100), 3)[::-1], np.repeat(np.arange(100) % 7, 3)[::-1])
    monkeypatch.setattr(S.np, "lexsort", lambda keys: pytest.fail("both parts were sorted"))
    assert (S._ranked(names)[2] == 3).all()


def test_equal_names_stay_as_they_come():
    a = np.arange(5_000, dtype=np.uint64) % np.uint64(11)
    b = (a % np.uint64(2)).astype(np.uint32)
    assert (S._order(a, b, "stable") == np.lexsort((b, a))).all()
