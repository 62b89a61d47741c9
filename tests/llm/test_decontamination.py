from __future__ import annotations

import re
from collections import Counter

from awkward_texts import awkward_texts
from siltworks.llm import decontamination

ITEMS = [
    (1, "oak1 elm2 Fir3"),
    (2, None),
    (3, ""),
    (4, "!!"),
    (5, "Überschrift ÄÖ é"),
    (6, "the same line again"),
    (6, "日本語"),
    (None, "another of two texts"),
    (7, "one of two texts of an id, with enough words to matter a lot more"),
    (1, "oak1 elm2 Fir3"),
]


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text)))


def plain(text, items, length):
    found = words(text)
    own = [m.group(0) for m in found]
    hit, names = set(), set()
    for item, other in items:
        w = [m.group(0) for m in words(other)]
        n = min(length, len(w))
        for at in range(len(w) - n + 1) if n else []:
            for p in range(len(own) - n + 1):
                if own[p : p + n] == w[at : at + n]:
                    hit.update(range(p, p + n))
                    names.add("" if item is None else str(item))
    spans = []
    for k in sorted(hit):
        if k - 1 in hit:
            spans[-1][1] = found[k].end()
        else:
            spans.append([found[k].start(), found[k].end()])
    return len(own), len(hit), tuple(sorted(names)), tuple(map(tuple, spans))


def test_equals_plain_version(spark, awkward):
    texts = [(k, t) for k, t in awkward_texts() if not t or len(t) < 10_000]
    shared = [t for k, t in texts if k == 1][0]
    items = [*ITEMS, (8, " ".join(shared.split()[3:20]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for max_bytes in (8_000_000, 300):  # one automaton, and several
        found = decontamination.find_passages(
            awkward.where("text is null or length(text) < 10000"), bench, length=10, max_bytes=max_bytes
        )
        got = Counter(
            (r.doc_id, r.text, r.hits.n_words, r.hits.n_hit, tuple(r.hits["items"]), tuple(map(tuple, r.hits.spans)))
            for r in found.collect()
        )
        assert got == Counter((k, t, *plain(t, items, 10)) for k, t in texts)


def test_whole_text_is_scanned(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame([(1, "word " * 100_000 + item.upper())], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    row = decontamination.find_passages(docs, bench).first()
    assert (row.hits.n_words, row.hits.n_hit, row.hits["items"]) == (100_011, 11, ["9"])
    assert row.hits.spans == [[500_000, 500_000 + len(item)]]


def test_empty_tables(spark, awkward, nothing):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_passages(nothing, bench).collect() == []
    none = decontamination.find_passages(awkward, bench.where("false"))
    assert {r.hits.n_hit for r in none.collect()} == {0}
    assert set(none.columns) == set(awkward.columns)
