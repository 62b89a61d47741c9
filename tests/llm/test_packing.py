from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from awkward_texts import awkward_texts
from siltworks.llm import packing
from siltworks.llm.queries import tokenizer_path
from tokenizers import Tokenizer


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for k, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            yield k, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), tuple(part)


def gapless(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_and_places(awkward, capacity):
    rows = packing.pack(awkward, tokenizer_path(), capacity=capacity, with_ids=True).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows)
    wanted = Counter(plain_pieces(awkward_texts(), capacity))
    assert got == wanted
    total = sum(r.length for r in rows)
    assert gapless(rows, capacity) <= -(-total // capacity) + 1


def test_odd_blanks_and_marks(spark):
    texts = ["a b c\x1cd", "café ñ", "<|endoftext|> x <|startoftext|>", "I'll don't", "\r\n\t tab", "ΑΣ ΟΔΟΣ İ"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.pieces(frame, tokenizer_path()).collect()}
    assert got == {(p[0], p[1]): p[4] for p in plain_pieces(enumerate(texts), 2048)}


def test_fullest_is_the_best_combination():
    rng = random.Random(3)
    for _ in range(200):
        pieces = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 9))]
        first = max(pieces)
        rest = sorted(pieces)
        rest.remove(first)
        best = max(first + sum(c) for n in range(len(rest) + 1) for c in combinations(rest, n) if first + sum(c) <= 50)
        chosen = packing.fullest(dict(Counter(pieces)), first, 50)
        assert sum(x * n for x, n in chosen.items()) == best
        assert all(n <= pieces.count(x) for x, n in chosen.items())


def test_plan_takes_each_piece_once_and_stays_short():
    rng = random.Random(5)
    histogram = Counter(min(2048, int(rng.expovariate(1 / 500)) + 1) for _ in range(300_000))
    planned = packing.plan(dict(histogram), 2048)
    taken = Counter()
    for times, chosen in planned:
        for x, n in chosen.items():
            taken[x] += n * times
    assert taken == histogram
    total = sum(x * n for x, n in histogram.items())
    assert sum(times for times, _ in planned) <= 1.001 * total / 2048 + 1
    assert len(planned) < 4 * 2048


def test_one_length_for_most_rows(spark):
    frame = spark.range(0, 20_000, 1, 7).selectExpr("id", "if(id % 3 = 0, 7, 1 + id % 90) AS length", "'x' AS offset")
    rows = packing.place(frame, capacity=100).collect()
    assert len(rows) == 20_000 and len({r.id for r in rows}) == 20_000
    assert len({(r.sequence_id, r.offset) for r in rows}) == 20_000
    assert gapless(rows, 100) <= -(-sum(r.length for r in rows) // 100) + 1


def test_sequences_hold_the_ids(awkward):
    packed = packing.stored(packing.pack(awkward, tokenizer_path(), capacity=512, with_ids=True))
    pieces = defaultdict(list)
    for r in packed.collect():
        pieces[r.sequence_id].append((r.offset, list(r.ids)))
    for r in packing.sequences(packed).collect():
        assert r.ids == [x for _, ids in sorted(pieces[r.sequence_id]) for x in ids]


def test_empty_and_wrong(spark, nothing):
    assert packing.pack(nothing, tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        packing.place(spark.createDataFrame([(9,)], "length int"), capacity=8)


def test_new_words_are_looked_up_among_the_known():
    """Going through all known words for each block of texts cost a fifth of the time."""

    class Known(dict):
        def keys(self):
            raise AssertionError("all known words are gone through")

    encoder, plain = packing.Encoder(tokenizer_path()), packing.Encoder(tokenizer_path())
    encoder.known = Known()
    texts = [" ".join(f"wörd{n} Number{n * k}" for n in range(300)) for k in range(3)]
    assert [encoder.ids([t])[0] for t in texts] == plain.ids(texts)
    assert plain.ids(texts)[0] == np.array(plain.tokenizer.encode(texts[0], add_special_tokens=False).ids, dtype="<u4").tobytes()
