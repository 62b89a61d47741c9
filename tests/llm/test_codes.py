"""Vector codes against a plain version in Python's integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.llm import codes, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows: list, entries: int = 256, rounds: int = 4) -> Counter:
    usable = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not usable:
        return Counter()
    size = max(Counter(len(r[1]) for r in usable).items(), key=lambda c: (c[1], c[0]))[0]
    usable = [r for r in usable if len(r[1]) == size]
    ints = [[math.floor(Fraction(x) * 1024) for x in r[1]] for r in usable]
    ints = [[max(-(1 << 62), min(1 << 62, x)) for x in v] for v in ints]
    cuts = [p * (size // 4) + min(p, size % 4) for p in range(5)]
    first = sorted(range(len(usable)), key=lambda k: (usable[k][0] is None, usable[k][0] or 0, usable[k][1]))[:entries]
    books = [[ints[k][a:b] for k in first] for a, b in zip(cuts, cuts[1:], strict=False)]

    def nearest(v, book):
        apart = [sum((x - y) ** 2 for x, y in zip(v, e, strict=True)) for e in book]
        return apart.index(min(apart)), min(apart)

    def all_nearest():
        return [[nearest(v[a:b], book) for a, b, book in zip(cuts, cuts[1:], books, strict=False)] for v in ints]

    for _ in range(rounds):
        members = defaultdict(list)
        for v, near in zip(ints, all_nearest(), strict=True):
            for p, (code, _) in enumerate(near):
                members[p, code].append(v[cuts[p] : cuts[p + 1]])
        for (p, code), parts in members.items():
            books[p][code] = [sum(xs) // len(parts) for xs in zip(*parts, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most, final = (1 << 63) - 1, all_nearest()
    errors = [min(most, sum(d for _, d in near)) for near in final]
    by_label: dict = defaultdict(int)
    for r, error in zip(usable, errors, strict=True):
        by_label[r[2]] += error
    return Counter(
        (r[0], "".join(f"{c:02x}" for c, _ in near), error, min(most, by_label[r[2]]), digest)
        for r, near, error in zip(usable, final, errors, strict=True)
    )


def coded(spark, rows, tmp_path, schema=SCHEMA) -> Counter:
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return Counter(map(tuple, queries.op13_vector_codes(spark, str(tmp_path)).collect()))


def vectors(rng: random.Random, n: int, size: int, spread: float) -> list:
    return [(3 * k, [rng.gauss(0, spread) for _ in range(size)], rng.choice((1, 2, 2, 2, None))) for k in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.integers(0, 61), st.integers(0, 61))
def test_products_are_exact(seed, size, of_x, of_y):
    rng = random.Random(seed)
    x, y = ([[rng.randint(-(2**e), 2**e) for _ in range(size)] for _ in range(5)] for e in (of_x, of_y))
    found = codes.products(np.array(x), np.array(y)).tolist()
    wanted = [[sum(a * b for a, b in zip(r, s, strict=True)) for s in y] for r in x]
    assert [[v % 2**64 for v in row] for row in found] == [[v % 2**64 for v in row] for row in wanted]


@pytest.mark.parametrize("terms", [1, 3, 4, 16, 17, 1000, 4096])
def test_limbs_stay_exact(terms):
    bits = codes.limb_bits(terms)
    assert terms * (2**bits) ** 2 < 2**53
    x = np.array([[0, 1, -1, 2**40 + 7, -(2**62)]])
    parts = [part.ravel().tolist() for part in codes.limbs(x, bits)]
    assert [sum(int(v) << bits * k for k, v in enumerate(column)) for column in zip(*parts, strict=True)] == x[0].tolist()


@pytest.mark.parametrize("spread", [0.2, 30.0, 1e6])
def test_equals_plain(spark, tmp_path, spread):
    rows = vectors(random.Random(2), 400, 16, spread)
    assert coded(spark, rows, tmp_path) == plain(rows)


def test_ties_repeats_and_unused_entries(spark, tmp_path):
    """Equal vectors share the lowest entry; the others keep what they start with."""
    rng = random.Random(7)
    few = [[rng.choice((-0.001, 0.0, 0.5)) for _ in range(8)] for _ in range(5)]
    rows = [(k, few[k % 5], 1) for k in range(300)] + [(7, few[0], None)] * 40 + [(None, few[1], None)] * 3
    assert coded(spark, rows, tmp_path) == plain(rows)


def test_rows_that_take_no_part(spark, tmp_path):
    rows = vectors(random.Random(4), 50, 10, 1.0)
    odd = [None, [], [1.0], [None] * 10, [1.0] * 9 + [None], [1.0] * 9 + [float("nan")], [float("-inf")] + [0.0] * 9]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(-1 - k, v, 1) for k, v in enumerate(odd)]
    rows += [(2000, [0.0] * 10, 5), (2001, [-1e-9] * 10, 5)]
    assert coded(spark, rows, tmp_path) == plain(rows)


def test_largest_components(spark, tmp_path):
    """Distances and components beyond 64 bits stop at their limits."""
    rows = vectors(random.Random(5), 60, 8, 1e9) + [(5, [1e300] * 8, 1), (6, [-1e300] * 8, 1), (8, [3e15] * 8, 9)]
    assert coded(spark, rows, tmp_path) == plain(rows)


def test_few_or_no_rows(spark, tmp_path):
    rows = vectors(random.Random(6), 3, 4, 1.0)
    assert coded(spark, rows, tmp_path / "few") == plain(rows)
    assert coded(spark, [(1, None, 1)], tmp_path / "unusable") == Counter()
    assert coded(spark, [], tmp_path / "none") == Counter()


def test_floats_and_clashing_columns(spark, tmp_path):
    rows = [(k, [float(np.float32(x)) for x in v], label) for k, v, label in vectors(random.Random(8), 80, 8, 1.0)]
    floats = "vec_id long, embedding array<float>, label int"
    assert coded(spark, rows, tmp_path, floats) == plain(rows)
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], floats + ", row string, code string, Coded string")
    model = codes.train(df)
    out = codes.encode(df, model)
    assert out.columns == ["vec_id", "embedding", "label", "row", "code", "coded"]
    assert out.count() == len(rows) and out.first()["row"] == "a"
    summed = codes.with_label_error(out.withColumn("error", out["coded.error"]), label_col="label", error_col="error", out="Row")
    assert summed.columns == ["vec_id", "embedding", "label", "code", "coded", "error", "Row"]
    by_label: dict = defaultdict(int)
    found = summed.collect()
    for r in found:
        by_label[r["label"]] += r["error"]
    assert len(found) == len(rows) and all(r["Row"] == by_label[r["label"]] for r in found)
