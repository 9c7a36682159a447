"""Numbers, short names and names on the next line that give an entity away."""

import pytest
from llm_cases import prose, stored

from millrace.llm import pii

FILLER = [(100 + k, "\n".join(prose(200 + k, 12, 60) for _ in range(4))) for k in range(60)]


@pytest.mark.parametrize(
    "told,term",
    [
        (lambda a, b: f"{a} account 7730915 is z.o@mail.example.org {b}", "7730915"),
        (lambda a, b: f"{a} Ng writes as z.o@mail.example.org {b}", "Ng"),
        (lambda a, b: f"{a}\nZorvex\nz.o@mail.example.org", "Zorvex"),
        (lambda a, b: f"z.o@mail.example.org {a}\nZorvex {b}", "Zorvex"),
    ],
)
def test_terms_that_were_left_out(spark, tmp_path, told, term):
    rows = FILLER + [(150_000 + k, told(prose(300 + k, 6, 60), prose(400 + k, 3, 60))) for k in range(5)]
    rows.append((1, f"it was {term} again"))
    docs = stored(spark, tmp_path, rows)
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in pii.spans(docs).collect() if r.added}
    assert added[1] == [(7, 7 + len(term))]
    assert not set(added) & {i for i, _ in FILLER}


def test_copies_of_a_block_prove_nothing(spark, tmp_path):
    rows = FILLER + [(1000 + k, "one\nZorvex\nz.o@mail.example.org") for k in range(5)]
    assert not any(r.added for r in pii.spans(stored(spark, tmp_path, rows)).collect())
