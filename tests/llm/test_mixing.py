"""Mixing against a plain version that sorts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from awkward_texts import awkward_texts
from pyspark.sql import functions as F

from siltworks.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def place_of(doc_id, text):
    parts = [str(doc_id)] if doc_id is not None else []
    parts += [hashlib.md5(text.encode()).hexdigest()] if text is not None else []
    return int(hashlib.md5("/".join(parts).encode()).hexdigest()[:15], 16)


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        share = {s: Fraction(weight[s] * rest, sum(weight[t] for t in names if t not in full)) for s in names if s not in full}
        above = {s for s, x in share.items() if x > most * sizes[s]}
        if not above:
            return {s: float(share.get(s, most * sizes[s])) for s in names}
        full |= above


def plain(rows: list, **how) -> Counter:
    sizes: dict = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    target, out = plain_targets(sizes, **how), Counter()
    for source, wanted in target.items():
        own = [(place_of(k, t), size_of(t), k) for k, t, s in rows if s == source]
        every = min(how.get("most", 3), int(wanted // sizes[source])) if sizes[source] else 0
        left, before, extra = wanted - every * sizes[source], 0, set()
        for at in sorted({p for p, n, _ in own if n}):
            words = sum(n for p, n, _ in own if p == at)
            if left <= before or before + words >= left and not before + words - left < left - before:
                break
            extra.add(at)
            before += words
        for at, n, k in own:
            out[k, n, sizes[source], wanted, n * (every + (at in extra))] += 1
    return out


def mixed(df, **how) -> Counter:
    found = mixing.mix(df, **how).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken").collect()
    return Counter(map(tuple, found))


def without_target(rows: Counter) -> Counter:
    return Counter((k, n, m, taken) for k, n, m, _, taken in rows.elements())


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got, wanted = mixed(df, **how), plain(rows, **how)
    assert without_target(got) == without_target(wanted)
    by = {(k, m): x for k, _, m, x, _ in got}
    assert all(by[k, m] == pytest.approx(x, rel=1e-12) for k, _, m, x, _ in wanted)
    return got


@pytest.mark.parametrize("seed", range(4))
def test_equals_plain(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "\U0001f600", "￿", None, "", "hot", "tiny"]
    rows = []
    for k in range(600):
        source = "hot" if k % 3 == 0 else rng.choice(names)
        rows.append((k, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(60))), source))
    rows += [(700, "only this one", "rare"), (701, None, "nothing"), (702, "", "nothing")]
    check(spark, rows)
    check(spark, rows, weights=(5, 1), most=2)


def test_near_targets_and_nested(spark):
    rng = random.Random(9)
    rows = [(k, "w " * rng.randrange(1, 100), f"s{k % 7}") for k in range(3000)]
    got = check(spark, rows)
    source = {k: s for k, _, s in rows}
    taken, target = Counter(), {}
    for k, size, _, wanted, n in got:
        taken[source[k]] += n
        target[source[k]] = wanted
        assert n in (0, size, 2 * size, 3 * size)
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)

    sized = spark.createDataFrame([(s, place_of(k, t), size_of(t)) for k, t, s in rows], "source string, place long, size long")
    budgets = [("s1", level, budget) for level, budget in enumerate([0.0, 10.0, 500.0, 501.0, 9000.0])]
    found = {r.level: r.below for r in mixing.thresholds(sized, spark.createDataFrame(budgets, "source string, level int, budget double")).collect()}
    assert sorted(found) == [1, 2, 3, 4] and sorted(found.values()) == [found[k] for k in sorted(found)]
    for level, budget in list(enumerate([0.0, 10.0, 500.0, 501.0, 9000.0]))[1:]:
        words = sized.where((F.col("source") == "s1") & (F.col("place") < found[level])).agg(F.sum("size")).first()[0] or 0
        assert abs(words - budget) <= 50


def test_repeated_rows_and_one_source(spark):
    check(spark, [(1, "a b c", "x")] * 5 + [(2, "d", "x"), (3, "e f", "y"), (None, "g h", "y"), (None, "g h", None)])
    check(spark, [(k, "a b", "x") for k in range(9)])
    check(spark, [(k, None, "x") for k in range(3)])


def test_same_on_every_run_and_partitioning(spark):
    rows = [(k, "w " * (k % 50), f"s{k % 3}") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixed(df.repartition(1)) == mixed(df.repartition(17))


def test_sources_sent_or_joined(spark, monkeypatch):
    rows = [(k, "w " * (k % 50), f"s{k % 40}") for k in range(500)]
    monkeypatch.setattr(mixing, "small", lambda df: df)
    check(spark, rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(k, t, s) for k, t, s in (tuple(r) for r in awkward.select("doc_id", "text", "lang").collect())]
    assert len(rows) == len(awkward_texts())
    got = mixed(awkward, source_col="lang")
    assert without_target(got) == without_target(plain(rows))
    out = mixing.mix(awkward, source_col="lang", out="VERSION")
    assert out.columns == [c for c in awkward.columns if c != "version"] + ["VERSION"]
    assert mixing.mix(nothing, source_col="lang").count() == 0


def test_no_python_rows(spark, awkward):
    plan = mixing.mix(awkward, source_col="lang")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
