"""Personal data in very long lines and runs, against the patterns themselves."""

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import stored

from millrace.llm import pii


def by_pattern(text):
    found = [(m.start(), "email", m.end()) for m in pii.EMAIL.finditer(text)]
    found += [(m.start(), "ip", m.end()) for m in pii.IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), "card", m.end()))
    for m in pii.PHONE.finditer(text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1.@-% +(0é\n", max_size=60) | st.text(alphabet="1204.", max_size=60) | st.text(alphabet="ab@.", max_size=40))
def test_same_as_the_patterns(text):
    assert [s[:3] for s in pii.base_spans(text)] == by_pattern(text)


def test_long_runs_take_no_longer_than_their_length():
    begin = time.time()
    for text in ("1" * 1_000_000, "1." * 500_000, "a" * 1_000_000 + "@@" + "b" * 1_000_000, "a@" * 500_000, "+1 " + " " * 1_000_000):
        pii.base_spans(text)
    assert time.time() - begin < 5


def test_long_lines_of_addresses(spark, tmp_path):
    names = [f"name{i}x" for i in range(1_500)]
    line = " ".join(f"{n} {n}@host{i}.example.org" for i, n in enumerate(names))
    assert len(line) > 40_000
    wide = " ".join(f"u{i}@h{i}.org" for i in range(20_000))
    docs = stored(spark, tmp_path, [(1, line), (2, wide), (3, "plain"), (4, line + " a"), (5, line + " b")])
    begin = time.time()
    got = {r.doc_id: r for r in pii.spans(docs).collect()}
    assert len(got[1].base) == 1_500 and len(got[2].base) == 20_000 and not got[3].base
    # Three different lines hold each address and all names, which stand nowhere else.
    assert len(got[1].added) >= 1_500
    assert time.time() - begin < 120
