"""Runs against a plain search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from awkward_texts import awkward_texts
from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.llm import periodic, queries


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every period in turn, smaller ones first."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x, n, found = np.array([number[w] for w in words]), len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        for same in np.split(x[q:] == x[:-q], np.flatnonzero(np.diff(x[q:] == x[:-q])) + 1):
            if same[0] and len(same) + q >= max(6, 4 * q):
                s, e = at, at + len(same) + q
                if all((x[s : e - d] != x[s + d : e]).any() for d in range(1, q)):
                    found.append((s, e - s, q))
            at += len(same)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_kept(words: list, runs: list) -> list:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def found(texts: list, **how) -> list:
    import pyarrow as pa

    return periodic._told(pa.array(texts, pa.string()), how.get("words_at_once", 300_000)).to_pylist()


def check(texts: list, **how) -> None:
    for text, row in zip(texts, found(texts, **how), strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == runs
        assert row["n_words"] == len(words)
        assert row["kept"] == " ".join(plain_kept(words, runs))


def repeating(rng: random.Random, period: int, times: float, letters: int, noise: int) -> str:
    def of(n):
        return [f"w{rng.randrange(letters)}" for _ in range(n)]

    once = of(period)
    return " ".join(of(noise) + [once[i % period] for i in range(int(times * period))] + of(noise))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc ", max_size=120).map(" ".join), max_size=6))
def test_few_letters(texts):
    check(texts)


@pytest.mark.parametrize("seed", range(6))
def test_every_period(seed):
    """Periods at and beside the borders of scales; exponents just below and above four."""
    rng = random.Random(seed)
    texts = [
        repeating(rng, p, t, letters, rng.randrange(40))
        for p in (1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 100, 127, 128, 129)
        for t in (3.9, 4, 4.1, 7.5)
        for letters in (2, 50)
    ]
    check(texts)
    check(texts, words_at_once=500)


def test_nested_and_touching_runs():
    rng = random.Random(3)
    inner = " ".join(["a b c"] * 6 + ["d"] * 9 + ["e f"] * 5)
    thue = "0"
    while len(thue) < 2048:
        thue += thue.translate(str.maketrans("01", "10"))
    fib = ["a", "ab"]
    while len(fib[-1]) < 2000:
        fib.append(fib[-1] + fib[-2])
    check([
        " ".join([inner] * 5),
        " ".join([" ".join([inner] * 4 + ["x"])] * 4),
        " ".join(thue),
        " ".join([" ".join(thue)] * 4),
        " ".join(fib[-1]),
        " ".join(["same"] * 3000),
        " ".join(["a b a"] * 700),
        repeating(rng, 500, 4.0, 3, 7) + " " + repeating(rng, 499, 4.5, 1000, 0),
    ])


def test_blanks_are_these_six_only():
    text = "a\x0ba\x0ca\ra\ta\na\x1ca a a a a"
    assert found([text])[0]["n_words"] == len(re.findall(r"[^\x20\x09-\x0D]+", text))
    check([text])


def test_long_text_in_time():
    rng = random.Random(1)
    once = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    row = found([" ".join(once * 4 + once[:100])])[0]
    assert row["runs"] == [{"start": 0, "length": 240_100, "period": 60_000}]
    assert row["kept"] == " ".join(once)


def test_awkward_rows(spark, awkward, nothing):
    out = periodic.collapse(awkward, out="ID")
    assert out.columns == [c for c in awkward.columns if c != "id"] + ["ID"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.ID.n_words) for r in out.collect()) == sorted(
        (k is None, k or 0, t or "", len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t in awkward_texts()
    )
    eight = next(r.ID for r in out.collect() if r.doc_id == 8)
    assert [tuple(r) for r in eight.runs] == [(0, 2000, 4)] and eight.kept == "the same line again"
    assert periodic.collapse(nothing).count() == 0


def plain_digest(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(plain_kept(words, runs)).encode()).hexdigest(),
    )


def test_query(spark, tmp_path):
    """Planted repetitions in a small table: ids from 0 on, some texts without words."""
    rng = random.Random(5)
    rows = [(k, repeating(rng, 1 + k % 90, 3 + k % 5, 400, k % 30)) for k in range(400)]
    rows += [(1000 + k, ("", None, " \t", "one", "one two")[k % 5]) for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_periodic_runs(spark, str(tmp_path))
    assert Counter(map(tuple, out.collect())) == Counter(plain_digest(*r) for r in rows)
