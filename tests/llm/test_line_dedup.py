from __future__ import annotations

from collections import Counter

import pytest
from awkward_texts import awkward_texts
from siltworks.llm import line_dedup


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, min_docs):
    holders = {}
    for k, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(float("inf") if k is None else k)
    out = Counter()
    for k, text in rows:
        lines = (text or "").split("\n")
        own = float("inf") if k is None else k
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < min_docs or min(holders[key(x)]) == own]
        out[k, text, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_equals_plain_version(awkward, min_docs):
    found = line_dedup.dedup_lines(awkward, min_docs=min_docs).collect()
    got = Counter((r.doc_id, r.text, r.lines.n_lines, r.lines.n_dropped, r.lines.kept) for r in found)
    assert got == plain(awkward_texts(), min_docs)


def test_empty_table(nothing):
    assert line_dedup.dedup_lines(nothing).collect() == []


def test_no_python_on_the_way(awkward, capsys):
    line_dedup.dedup_lines(awkward).explain("formatted")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert not any(x in plan for x in ("PythonUDF", "EvalPython", "InPandas", "InArrow", "ArrowEval"))


def test_a_line_that_most_documents_hold(spark):
    rows = [(k, f"the very common line\nown line number {k}") for k in range(3000)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.lines.n_dropped for r in found) == 2999
    assert [r.lines.n_dropped for r in found if r.doc_id == 0] == [0]
