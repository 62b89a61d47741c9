from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from awkward_texts import awkward_texts
from siltworks.llm import repeats


def plain(rows, length):
    order = sorted({k for k, _ in rows if k is not None}) + [None]
    first = {}
    for rank, own in enumerate(order):
        for k, text in rows:
            if k == own:
                data = (text or "").encode()
                for at in range(len(data) - length + 1):
                    first.setdefault(data[at : at + length], rank)
    out = Counter()
    for k, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < order.index(k):
                gone[at : at + length] = b"\1" * length
        edges = [i for i in range(len(data) + 1) if (i and gone[i - 1]) != (i < len(data) and gone[i])] if data else []
        spans = tuple(zip(edges[::2], edges[1::2], strict=True))
        out[k, len(data), sum(gone), spans, bytes(x for x, g in zip(data, gone, strict=True) if not g)] += 1
    return out


def result(frame, **options):
    return Counter(
        (r.doc_id, r.n_bytes, r.n_removed, tuple(map(tuple, r.spans)), bytes(r.kept))
        for r in repeats.remove_repeats(frame, **options).collect()
    )


@pytest.mark.parametrize(("length", "block", "shard"), [(50, 16_000_000, 150_000), (50, 3_000, 40), (9, 50_000, 2_000)])
def test_equals_plain_version(awkward, length, block, shard):
    rows = [(k, t) for k, t in awkward_texts() if not t or len(t) < 60_000]
    frame = awkward.where("text is null or length(text) < 60000")
    assert result(frame, length=length, block_bytes=block, shard_records=shard) == plain(rows, length)


def test_very_long_texts_and_runs(spark):
    rng = random.Random(1)
    own = "".join(rng.choice("abcdef \n") for _ in range(120_000))
    rows = [(1, own), (2, own[50_000:]), (3, "x" * 90_000), (4, "y" + "x" * 49 + "y" + "x" * 60), (5, own[:49]), (6, "é" * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in repeats.remove_repeats(frame).collect()}
    assert got == {1: (120_000, 0), 2: (70_000, 70_000), 3: (90_000, 0), 4: (111, 60), 5: (49, 0), 6: (80, 0)}


def test_random_tables(spark):
    rng = random.Random(8)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 40))) for _ in range(12)]
    rows = [(rng.randrange(60), "".join(rng.choice(pieces) for _ in range(rng.randrange(6)))) for _ in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(frame, length=20, block_bytes=500, shard_records=30, shard_anchors=50) == plain(rows, 20)


def test_levels_merge_geometrically():
    levels, rng = repeats.Levels(), np.random.default_rng(2)
    parts = rng.permutation(np.array([b"%06d\0" % k for k in range(640)], dtype="S7")).reshape(64, 10)
    for k, part in enumerate(parts):
        part = np.sort(part)
        assert (levels.scan(part) == repeats.LAST).all()
        levels.add(part, np.full(10, k))
    assert len(levels.held) <= 7 and all((np.sort(s) == s).all() for s, _ in levels.held)
    assert (levels.scan(np.sort(parts[5])) == 5).all()
    mixed = np.sort(np.append(parts[9][:3], [b"x", b"0"]))
    assert sorted(levels.scan(mixed).tolist()) == [9, 9, 9, repeats.LAST, repeats.LAST]


def test_suffixes_are_compared_as_bytes():
    """Zero bytes, also at the end, and bytes of 128 and more."""
    shape = repeats.Shape(4)
    strings = [b"\0\0\0\0", b"a\0\0\0", b"a\0\0b", b"\xff\x80\0\0", b"\x7f\x80\0\0"]
    around = np.zeros((2 * len(strings), shape.around + 2), dtype=np.uint8)
    for k, string in enumerate(strings * 2):
        around[k, shape.left : shape.left + 4] = np.frombuffer(string, np.uint8)
    found = repeats._earlier(around, np.arange(len(around)), shape)
    assert found[:, 0].tolist() == [False] * len(strings) + [True] * len(strings)


@pytest.mark.parametrize("frequent", [0, 2, 30])
@pytest.mark.parametrize("length", [20, 50])
def test_frequent_anchors(spark, frequent, length):
    """Anchors over the bound are matched string by string, with the same result."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = []
    for k in range(90):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(200)))
        rows.append((rng.randrange(70), own[:90] + (passage if k % 3 else passage[10:70]) + own[90:]))
    rows += [(None, passage), (None, passage + passage), (5, "x" * 300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = result(frame, length=length, block_bytes=2_000, shard_records=200, shard_anchors=300, frequent=frequent, shard_strings=500)
    assert got == plain(rows, length)


def test_one_passage_in_many_documents(spark, monkeypatch, tmp_path):
    """20,000 documents with one passage between their own words: no group of records or strings gets
    more than the bounds allow."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)
    passage = letters[rng.integers(0, 27, 180)].tobytes().decode()
    own = [letters[rng.integers(0, 27, 160)].tobytes().decode() for _ in range(20_000)]
    rows = [(k, t[:80] + passage + t[80:]) for k, t in enumerate(own)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)

    folder = str(tmp_path)
    match = repeats._match

    def watched(shape, shards):
        inner = match(shape, shards)

        def run(table):
            import pathlib
            import uuid

            import zstandard

            count = sum(len(zstandard.decompress(r["low"])) // 8 for r in table.select(["low"]).to_pylist())
            kind = "strings" if table["shard"][0].as_py() >= shards.records else "records"
            pathlib.Path(folder, f"{kind}-{count}-{uuid.uuid4().hex}").touch()
            return inner(table)

        return run

    monkeypatch.setattr(repeats, "_match", watched)
    how = {"block_bytes": 500_000, "shard_records": 10_000, "frequent": 2_000, "shard_strings": 200_000}
    got = {r.doc_id: (r.n_removed, bytes(r.kept).decode()) for r in repeats.remove_repeats(frame, **how).collect()}
    assert got[0] == (0, rows[0][1])
    assert all(got[k][0] >= 180 and got[k][1].startswith(t[:70]) and got[k][1].endswith(t[90:]) for k, t in enumerate(own) if k)
    assert sum(n for n, _ in got.values()) <= 19_999 * 200
    records, strings = ([int(f.name.split("-")[1]) for f in tmp_path.glob(f"{kind}-*")] for kind in ("records", "strings"))
    assert strings and max(strings) < 1.2 * how["shard_strings"]
    assert not records or max(records) < how["shard_records"] + 2 * how["frequent"]


def test_empty_table(nothing):
    assert repeats.remove_repeats(nothing).collect() == []
