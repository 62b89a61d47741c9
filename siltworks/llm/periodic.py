"""Stretches of words that repeat with a period four times or more.

Runs of a period below `SHORT` come from direct comparisons of the words at each of these distances.
For longer ones, scale by scale, words are covered by minimizers: at scale w, the fingerprints of 2w
words that are the smallest of some w neighbouring ones. A run of period q, w <= q < 2w, is at least
4q long, so it holds a window of 3w - 1 words and the same one q words later, which choose the same
place. Equal fingerprints less than q apart cannot lie in it, since they would make its period
smaller. So two minimizers that follow each other with equal fingerprints are exactly q apart, and
such pairs, of which there are no more than minimizers, are the seeds. A seed is extended to both
sides by comparing words, so fingerprints (64 bits) never decide what a run is.

All is numpy over many documents at once, which a symbol of their own divides. Only texts and
results move; nothing is shuffled or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import opened, whole

RUNS = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, kept: string>"
#: Smallest period that is found through minimizers; a power of two.
SHORT = 8
#: Least length of a run: this many words, and this many periods.
LEAST, TIMES = 6, 4


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of pairs."""
    z = x * np.uint64(0x9E3779B97F4A7C15) + (y ^ (y >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(32)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(29))


def _doubled(prints: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of 2 * `length` symbols from those of `length`; nothing follows the end."""
    after = np.zeros_like(prints)
    after[:-length] = prints[length:]
    return _mixed(prints, after)


def _minimizers(prints: np.ndarray, width: int) -> np.ndarray:
    """Places whose fingerprint is the smallest of some `width` neighbours; all of equal ones."""
    least, step = prints.copy(), 1
    while step < width:
        least[:-step] = np.minimum(least[:-step], least[step:])
        step *= 2
    largest, step = least, 1
    while step < width:
        largest[step:] = np.maximum(largest[step:], largest[:-step])
        step *= 2
    return np.flatnonzero(largest == prints)


def _first_difference(symbols: np.ndarray, at: int, lag: int) -> int:
    """The first place from `at` on that differs from the one `lag` later."""
    size = 64
    while at + lag < len(symbols):
        later = symbols[at + lag : at + lag + size]
        differs = symbols[at : at + len(later)] != later
        if differs.any():
            return at + int(differs.argmax())
        at, size = at + len(later), 2 * size
    return at


def _last_difference(symbols: np.ndarray, at: int, lag: int) -> int:
    """The last place before `at` that differs from the one `lag` later, or -1."""
    size = 64
    while at > 0:
        low = max(0, at - size)
        differs = symbols[low:at] != symbols[low + lag : at + lag]
        if differs.any():
            return at - 1 - int(differs[::-1].argmax())
        at, size = low, 2 * size
    return -1


def _divisors(period: int) -> list[int]:
    """`period` divided by each of its prime factors."""
    found, rest, p = [], period, 2
    while rest > 1:
        p = p if p * p <= rest else rest
        if rest % p == 0:
            found.append(period // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return found


def _is_run(symbols: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether [start, end), which repeats at `period`, is long enough and has no smaller period."""
    if end - start < max(LEAST, TIMES * period):
        return False
    once = symbols[start : start + period]
    return not any((once[:-d] == once[d:]).all() for d in _divisors(period))


def _scanned(symbols: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """Longest stretches [start, end) that repeat at `period`, by comparing all words."""
    same = np.zeros(len(symbols) - period + 2, dtype=np.int8)
    same[1:-1] = symbols[:-period] == symbols[period:]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2]
    long_enough = ends - starts >= max(LEAST, TIMES * period) - period
    for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
        yield start, end + period


def _seeds(prints: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of minimizers that follow each other with equal fingerprints, lags of this scale."""
    places = _minimizers(prints, width)
    values = prints[places]
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    place = places[order[:-1][same]]
    lag = places[order[1:][same]] - place
    own = (lag >= width) & (lag < 2 * width)
    return place[own], lag[own]


def runs_of(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    `symbols` holds the documents one after the other, from `starts` on, `lengths` long, each with
    one symbol behind it that is found nowhere else.
    """
    found = []
    for period in range(1, SHORT):
        if TIMES * period <= lengths.max(initial=0):
            for start, end in _scanned(symbols, period):
                if _is_run(symbols, start, end, period):
                    found.append((start, end - start, period))

    width, at, prints, held = SHORT, None, None, lengths
    while TIMES * width <= lengths.max(initial=0):
        # Documents too short for this scale leave.
        stay = np.repeat(held >= TIMES * width, held + 1)
        held = held[held >= TIMES * width]
        if prints is None:
            at = np.flatnonzero(stay)
            prints = _mixed(symbols[at].astype(np.uint64), np.uint64(0) * at.astype(np.uint64))
            size = 1
        else:
            at, prints = at[stay], prints[stay]
        while size < 2 * width:
            prints = _doubled(prints, size)
            size *= 2
        place, lag = _seeds(prints, width)
        place = at[place]
        order = np.lexsort((place, lag))
        last, end = 0, 0
        for k in order.tolist():
            seed, period = int(place[k]), int(lag[k])
            if period == last and seed + period < end:
                continue  # within the stretch extended before
            start = _last_difference(symbols, seed, period) + 1
            last, end = period, _first_difference(symbols, seed, period) + period
            if _is_run(symbols, start, end, period):
                found.append((start, end - start, period))
        width *= 2
    rows = np.array(sorted({(s, p, n) for s, n, p in found}), dtype=np.int64).reshape(-1, 3)
    return rows[:, [0, 2, 1]]


def _found(words: list[list[bytes]]) -> list[tuple[np.ndarray, list[bytes]]]:
    """Per document its runs and the words that no run repeats."""
    together = [w for of in words for w in of]
    number = {w: k for k, w in enumerate(dict.fromkeys(together))}
    lengths = np.array([len(of) for of in words], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.empty(int(lengths.sum()) + len(words), dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[starts + lengths] = False
    symbols[inside] = np.fromiter(map(number.__getitem__, together), np.int64, len(together))
    symbols[~inside] = np.arange(len(words)) + len(number)
    rows = runs_of(symbols, starts, lengths)
    if not len(rows):
        return [(rows, of) for of in words]
    change = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    stays = np.cumsum(change[:-1]) == 0
    borders = np.searchsorted(rows[:, 0], np.append(starts, len(symbols)))
    out = []
    for k, of in enumerate(words):
        own = rows[borders[k] : borders[k + 1]]
        if len(own):
            kept = np.flatnonzero(stays[starts[k] : starts[k] + lengths[k]])
            out.append((own - [starts[k], 0, 0], [of[i] for i in kept.tolist()]))
        else:
            out.append((own, of))
    return out


def _together(texts: list[bytes | None], words_at_once: int) -> Iterator[list[list[bytes]]]:
    """Words of the texts, whole texts of about `words_at_once` words at a time."""
    group, n = [], 0
    for text in texts:
        # Without an argument, bytes are split at blank, tab, line feed, \x0b, \x0c and carriage return.
        words = (text or b"").split()
        if group and n + len(words) > words_at_once:
            yield group
            group, n = [], 0
        group.append(words)
        n += len(words)
    if group:
        yield group


def _told(texts: pa.Array, words_at_once: int) -> pa.Array:
    counts, offsets, rows, kept = [], [0], [], []
    for group in _together(texts.cast(pa.binary()).to_pylist(), words_at_once):
        for words, (runs, stay) in zip(group, _found(group), strict=True):
            counts.append(len(words))
            offsets.append(offsets[-1] + len(runs))
            rows.append(runs)
            kept.append(b" ".join(stay))
    flat = np.concatenate(rows) if rows else np.empty((0, 3), dtype=np.int64)
    runs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
            pa.array(kept, pa.binary()).view(pa.string()),
        ],
        ["n_words", "runs", "kept"],
    )


def _finder(words_at_once: int):
    def run(batches):
        for texts in batches:
            yield _told(texts, words_at_once)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RUNS)


def collapse(
    docs: DataFrame, *, text_col: str = "text", words_at_once: int = 300_000, out: str = "periodic"
) -> DataFrame:
    """All columns of `docs` and a struct `out` of (n_words, runs, kept).

    Words are what stands between blanks, tabs and line ends. A run is a stretch of words with
    smallest period `period`, at least 6 words and 4 periods long, that cannot be longer; runs come by
    start (number of the first word, from 0) and period, and may overlap. `kept` are the words, joined
    by a blank, that stand in no run behind its first period.

    Null, empty and blank texts have no words, no runs and an empty `kept`. Repeated rows stay, each
    with its result. Of a text of any length all words are looked at; `words_at_once` says how many
    words of shorter texts are treated in one go and changes no result. An input column named as
    `out` is replaced.
    """
    found = whole(docs).select("row", _finder(words_at_once)(F.col("row")[text_col]).alias("found"))
    return opened(found, docs.columns, **{out: F.col("found")})


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period. Null: none."""
    best = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    )
    return F.struct(
        (-best["col2"]).alias("start"), best["length"].alias("length"), (-best["col3"]).alias("period")
    )
