"""The way over several blocks of the benchmark."""

import test_llm_text

from millrace.llm import decontaminate


def test_contamination_over_several_blocks(spark, tmp_path, monkeypatch):
    counts, make = [], decontaminate._blocks

    def counted(*args):
        tests = list(make(*args))
        counts.append(len(tests))
        return iter(tests)

    monkeypatch.setattr(decontaminate, "_blocks", counted)
    test_llm_text.test_contamination(spark, tmp_path, monkeypatch, 400)
    assert max(counts) > 1
