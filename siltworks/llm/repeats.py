"""Byte passages that an earlier document holds too, by a logarithmic family of suffix arrays.

Suffixes are sparse: of every string of `length` bytes one inner point, its anchor, is chosen by its
content alone (the leftmost smallest hash of `inner` bytes), so equal strings have the same anchor
at the same place. Whatever happens to strings then happens anchor by anchor, and anchors are dealt
to shards by their hash.

1. Texts are packed in compressed blocks. Each block tells the shards its different anchors, four
   bytes each, and how often each comes; shards answer which of them come in more than one document
   or block, and which are frequent.
2. For those that are not frequent, each block sends the bytes around, once for equal surroundings. A
   shard takes them in the order of documents, in batches. A batch gets its suffix array: the suffixes
   of its surroundings in byte order. It is merge-scanned against the levels so far, each of them the
   sorted suffixes of earlier documents, and neighbours with a common prefix of `length` bytes are
   matches. What is new becomes a level, and levels of equal size are merged into one of twice the size.
3. A frequent anchor, say of a phrase or at the edges of a passage that a third of all documents hold,
   has other bytes around it in each document, so its surroundings are not gathered in one shard. Its
   strings are dealt to shards each by itself, by a 128-bit hash, and each block sends an equal one
   once, with the smallest id. So no shard's share grows with the documents of one passage.
4. The answers go back to the blocks, which mark and cut the bytes covered.

Blocks and shards are bounded in size and follow the data: a shard of surroundings has about
`shard_records` and at most `frequent` more, one of strings has as many as their hashes deal to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import blocks, stored, text_bytes

#: Stands for a missing id: after all others.
LAST = np.iinfo(np.int64).max
BASE, OTHER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
CHUNK = 1 << 18
#: Of compression: what is sent counts three times as disk.
LEVEL = 4
BATCH = 8192
SHIFT = np.uint64(24)


@dataclass(frozen=True)
class Shape:
    """Lengths of a string, of an anchor, and of what lies around an anchor on its left."""

    length: int

    @property
    def inner(self) -> int:
        return max(1, self.length // 2 - 1)

    @property
    def left(self) -> int:
        return self.length - self.inner

    @property
    def around(self) -> int:
        return self.left + self.length


def _hashes(data: np.ndarray, length: int, base: np.uint64 = BASE) -> np.ndarray:
    """A hash of the `length` items from each place on along the last axis, by doubling."""
    n = data.shape[-1] - length + 1
    done, out, power = 0, None, np.uint64(1)
    part, size = data.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        factor = base
        while size <= length:
            if length & size:
                here = part[..., done : done + n]
                power = factor
                out = here.copy() if out is None else out * power + here
                done += size
            if 2 * size <= length:
                part = part[..., :-size] * factor + part[..., size:]
            factor = factor * factor
            size *= 2
        out ^= out >> np.uint64(32)
        out *= MIX
        out ^= out >> np.uint64(29)
    return out


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of the `width` values from each place on."""
    size, part = 1, values
    while 2 * size <= width:
        part = np.minimum(part[:-size], part[size:])
        size *= 2
    rest = width - size
    return part if not rest else np.minimum(part[:-rest], part[rest:])


class Block:
    """Documents of one block, one after the other."""

    def __init__(self, blob: bytes, shape: Shape):
        import zstandard

        table = pa.ipc.open_stream(zstandard.decompress(blob)).read_all().combine_chunks()
        self.shape = shape
        self.ids = table["id"].to_numpy()
        texts = table["text"].chunk(0) if table.num_rows else pa.array([], pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.starts, self.ends = ends[:-1] - ends[0], ends[1:] - ends[0]
        raw = texts.buffers()[2]
        self.data = (
            np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.empty(0, np.uint8)
        )

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, first and last start of the strings it stands for, hash) of each anchor."""
        shape, data = self.shape, self.data
        whole = np.zeros(len(data) + 1, dtype=np.int8)
        long = self.ends - self.starts >= shape.length
        np.add.at(whole, self.starts[long], 1)
        np.add.at(whole, self.ends[long] - shape.length + 1, -1)
        whole = np.cumsum(whole[:-1], dtype=np.int8).view(bool)
        out = []
        for at in range(0, max(0, len(data) - shape.length + 1), CHUNK):
            some = data[at : at + CHUNK + shape.length - 1]
            hashes = _hashes(some, shape.inner)
            ranked = (hashes >> SHIFT << SHIFT) | np.arange(len(hashes), dtype=np.uint64)
            place = (_smallest(ranked, shape.left + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
            starts = np.flatnonzero(whole[at : at + len(place)])
            if not len(starts):
                continue
            chosen = place[starts]
            new = np.flatnonzero(np.append(True, np.diff(chosen) != 0))
            last = np.append(new[1:] - 1, len(chosen) - 1)
            out.append((chosen[new] + at, starts[new] + at, starts[last] + at, hashes[chosen[new]]))
        if not out:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def owners(self, places: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, places, side="right")]

    def repeated(self, known: dict[int, tuple[bytes, bytes]], shards: int):
        """(place, first and last start, hash) of the repeated anchors, not frequent and frequent ones
        apart, by the bits for either that shards have answered."""
        every = self.anchors()
        own = np.zeros((2, len(every[0])), dtype=bool)
        if known:
            keys = _Keys(every[3], shards)
            for shard, rows in keys.parts():
                if shard in known:
                    nth, count = keys.nth(rows), len(keys.starts(rows))
                    for k, data in enumerate(known[shard]):
                        own[k, rows] = np.unpackbits(np.frombuffer(data, np.uint8), count=count).view(bool)[nth]
        return [tuple(x[of] for x in every) for of in (own[0] & ~own[1], own[1])]

    def strings(self, first: np.ndarray, last: np.ndarray):
        """Of all strings of frequent anchors: (two hashes and smallest id of each different one; start,
        owner and string of each)."""
        counts = last - first + 1
        starts = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        owner = self.owners(starts)
        hashes = np.empty((2, len(starts)), dtype=np.uint64)
        if len(starts):
            windows = np.lib.stride_tricks.sliding_window_view(self.data, self.shape.length)
            for at in range(0, len(starts), 16_384):
                some = windows[starts[at : at + 16_384]]
                for k, base in enumerate((BASE, OTHER)):
                    hashes[k, at : at + len(some)] = _hashes(some, self.shape.length, base)[:, 0]
        order = np.lexsort((owner, hashes[1], hashes[0]))
        new = np.append(True, (np.diff(hashes[:, order]) != 0).any(axis=0))[: len(order)]
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        lead = order[new]
        return hashes[:, lead], owner[lead], starts, owner, kind

    def records(self, place: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray):
        """Of anchors: (records, hash and smallest id of each different one; owner and record of each
        anchor)."""
        shape = self.shape
        owner = self.owners(place)
        # Bytes around, zero where no string of this anchor reaches, and the span of string starts.
        padded = np.concatenate([np.zeros(shape.left, np.uint8), self.data, np.zeros(shape.length, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, shape.around)
        around = np.empty((len(place), shape.around + 2), dtype=np.uint8)
        key = np.empty(len(place), dtype=np.uint64)
        spots = np.arange(shape.around, dtype=np.uint8 if shape.around < 256 else np.int64)
        for at in range(0, len(place), 8192):
            some = slice(at, at + 8192)
            reach, back = place[some] - first[some], place[some] - last[some]
            inside = (spots >= (shape.left - reach)[:, None]) & (spots < (shape.left - back + shape.length)[:, None])
            around[some, :-2] = windows[place[some]] * inside
            around[some, -2], around[some, -1] = back, reach
            key[some] = _hashes(around[some], around.shape[1])[:, 0]
        # Equal surroundings have equal keys, so they are sought among neighbours in that order.
        order = np.lexsort((owner, key))
        flat = around.view(f"V{around.shape[1]}").ravel()
        new = np.append(True, flat[order[1:]] != flat[order[:-1]])[: len(order)]
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        lead = order[new]
        return around[lead], hashes[lead], owner[lead], owner, kind


def _pack(block_bytes: int):
    def blob(ids, texts):
        import zstandard

        table = pa.table({"id": pa.concat_arrays(ids), "text": pa.concat_arrays(texts)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table.combine_chunks())
        packed = zstandard.compress(sink.getvalue().to_pybytes(), LEVEL)
        return pa.RecordBatch.from_arrays([pa.array([packed], pa.large_binary())], ["blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids.append(some.column(0).cast(pa.int64()))
                texts.append(some.column(1).cast(pa.large_binary()))
                size += pc.sum(pc.binary_length(texts[-1])).as_py()
                if size >= block_bytes:
                    yield blob(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield blob(ids, texts)

    return run


def _dealt(to: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, rows) of each shard that gets rows, which stay in order."""
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(count + 1))
    for shard in np.flatnonzero(np.diff(ends)):
        yield int(shard), order[ends[shard] : ends[shard + 1]]


class _Keys:
    """Anchors of a block by shard, where each is a 32-bit number.

    Two different anchors may share a number, about one in four thousand within a full shard; then
    more surroundings are compared than need be, and nothing else changes.
    """

    def __init__(self, hashes: np.ndarray, shards: int):
        self.shards = shards
        self.shard = (hashes % np.uint64(shards)).astype(np.int64)
        self.number = (hashes >> np.uint64(32)).astype(np.uint32)
        self.order = np.lexsort((self.number, self.shard))

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, rows in the order of their numbers)."""
        ends = np.searchsorted(self.shard[self.order], np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(ends)):
            yield int(shard), self.order[ends[shard] : ends[shard + 1]]

    def starts(self, rows: np.ndarray) -> np.ndarray:
        """Where each different number begins among `rows`."""
        return np.flatnonzero(np.append(True, np.diff(self.number[rows]) != 0))

    def nth(self, rows: np.ndarray) -> np.ndarray:
        """Of each of `rows`, which of the different numbers it has."""
        starts = self.starts(rows)
        return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))


ASKED = "shard int, block long, numbers binary, many binary, counts binary"
#: A block tells of more occurrences of an anchor as this many.
MOST = 255


def _ask(shape: Shape, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own = Block(row["blob"], shape)
                place, _, _, hashes = own.anchors()
                owner, keys = own.owners(place), _Keys(hashes, shards)
                out: list[list] = [[], [], [], [], []]
                for shard, rows in keys.parts():
                    starts = keys.starts(rows)
                    counts = np.minimum(np.diff(np.append(starts, len(rows))), MOST).astype(np.uint8)
                    # In more than one document of this block?
                    many = np.minimum.reduceat(owner[rows], starts) < np.maximum.reduceat(owner[rows], starts)
                    numbers = keys.number[rows][starts].tobytes()
                    values = (shard, row["block"], numbers, np.packbits(many).tobytes(), counts.tobytes())
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)],
                    ["shard", "block", "numbers", "many", "counts"],
                )

    return run


KNOWN = "block long, shard int, repeated binary, frequent binary, n long, n_frequent long"


def _answer(frequent: int):
    """Which of each block's anchors are in more than one document, or block, and which of these are
    frequent, as bits; and how often either come in the block."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        numbers = [np.frombuffer(r["numbers"], np.uint32) for r in rows]
        many = [np.unpackbits(np.frombuffer(r["many"], np.uint8), count=len(n)) for r, n in zip(rows, numbers, strict=True)]
        times = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows]).astype(np.int64)
        _, where, counts = np.unique(np.concatenate(numbers), return_inverse=True, return_counts=True)
        repeated = counts > 1
        repeated[where[np.concatenate(many) > 0]] = True
        often = repeated & (np.bincount(where, times) > frequent)
        ends = np.cumsum([len(n) for n in numbers])[:-1]
        found, hot, times = (np.split(x, ends) for x in (repeated[where], often[where], times))
        bits = [[pa.array([np.packbits(x).tobytes() for x in of], pa.binary())] for of in (found, hot)]
        return pa.table(
            {
                "block": pa.array([r["block"] for r in rows], pa.int64()),
                "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "repeated": bits[0][0],
                "frequent": bits[1][0],
                "n": pa.array([int(t[x & ~h].sum()) for t, x, h in zip(times, found, hot, strict=True)], pa.int64()),
                "n_frequent": pa.array([int(t[h].sum()) for t, h in zip(times, hot, strict=True)], pa.int64()),
            }
        )

    return run


SENT = "shard int, block long, around binary, low binary"


def _gathered(table: pa.Table) -> tuple[bytes, dict[int, tuple[bytes, bytes]], dict[int, bytes]]:
    """Of a block's rows: its blob, which anchors are repeated and frequent, and answers, by shard."""
    blob, known, answers = b"", {}, {}
    for k in range(table.num_rows):
        row = table.slice(k, 1).to_pylist()[0]
        if row["blob"] is not None:
            blob = row["blob"]
        elif row["repeated"] is not None:
            known[row["shard"]] = row["repeated"], row["frequent"]
        else:
            answers[row["shard"]] = row["answers"]
    return blob, known, answers


@dataclass(frozen=True)
class Shards:
    """Numbers of shards: of anchors, of surroundings, and of strings, which are counted on from there."""

    anchors: int
    records: int
    strings: int

    def of_records(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        return _dealt(_second(hashes, self.records), self.records)

    def of_strings(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for shard, rows in _dealt((hashes[0] % np.uint64(self.strings)).astype(np.int64), self.strings):
            yield self.records + shard, rows


def _send(shape: Shape, shards: Shards):
    def run(table: pa.Table) -> pa.Table:
        blob, known, _ = _gathered(table)
        own = Block(blob, shape)
        rare, often = own.repeated(known, shards.anchors)
        around, hashes, low, *_ = own.records(*rare)
        parts = [(s, around[r].tobytes(), low[r]) for s, r in shards.of_records(hashes)]
        prints, low, *_ = own.strings(often[1], often[2])
        parts += [(s, prints[:, r].tobytes(), low[r]) for s, r in shards.of_strings(prints)]
        return pa.table(
            {
                "shard": pa.array([s for s, _, _ in parts], pa.int32()),
                "block": pa.array([table["block"][0].as_py()] * len(parts), pa.int64()),
                "around": pa.array([_zip(data) for _, data, _ in parts], pa.binary()),
                "low": pa.array([_zip(ids.tobytes()) for _, _, ids in parts], pa.binary()),
            }
        )

    return run


def _second(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def _zip(data: bytes) -> bytes:
    import zstandard

    return zstandard.compress(data, LEVEL)


class Levels:
    """Suffixes in byte order, with the smallest id that holds each, in levels about twice as long each
    as the next."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, suffixes: np.ndarray) -> np.ndarray:
        """The id that the levels have for each of a suffix array's different suffixes; LAST if none.

        Both are sorted, so putting them in one order merges two runs; a match stands behind its twin.
        """
        ids = np.full(len(suffixes), LAST)
        for level, owners in self.held:
            merged, order = _merged(level, suffixes)
            twin = np.flatnonzero(merged[1:] == merged[:-1])
            ids[order[twin + 1] - len(level)] = owners[order[twin]]
        return ids

    def add(self, suffixes: np.ndarray, ids: np.ndarray) -> None:
        if not len(suffixes):
            return
        self.held.append((suffixes, ids))
        while len(self.held) > 1 and len(self.held[-1][0]) * 2 > len(self.held[-2][0]):
            late, early = self.held.pop(), self.held.pop()
            merged, order = _merged(early[0], late[0])
            self.held.append((merged, np.concatenate([early[1], late[1]])[order]))


def _merged(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted arrays in one order, and where in the two each comes from; equal ones of `one` first."""
    both = np.concatenate([one, other])
    order = np.argsort(both, kind="stable")
    return both[order], order


def _earlier(around: np.ndarray, low: np.ndarray, shape: Shape) -> np.ndarray:
    """For each record, bits of the starts (distance before the anchor) whose string an earlier
    document holds.

    Of equal records only that of the smallest id has suffixes of its own; what the others hold is
    held by it.
    """
    by_id = np.argsort(low, kind="stable")
    flat = np.ascontiguousarray(around[by_id]).view(f"S{around.shape[1]}").ravel()
    order = np.argsort(flat, kind="stable")
    new = np.append(True, flat[order[1:]] != flat[order[:-1]])[: len(order)]
    order = by_id[order]
    lead = order[new]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    back, reach = around[:, -2:-1], around[:, -1:]
    spots = np.arange(shape.left + 1)
    all_of = (spots >= back) & (spots <= reach)
    found = _earlier_of_different(around[lead], low[lead], shape)
    return np.where((low > low[lead][kind])[:, None], all_of, found[kind])


def _earlier_of_different(around: np.ndarray, low: np.ndarray, shape: Shape) -> np.ndarray:
    """The same for records no two of which are equal."""
    width = around.shape[1]
    windows = np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(around).ravel(), shape.length)
    out = np.zeros((len(around), shape.left + 1), dtype=bool)
    order = np.argsort(low, kind="stable")
    levels = Levels()
    back = np.arange(shape.left, -1, -1)  # column c starts `left - c` before the anchor
    for at in range(0, len(order), BATCH):
        own = order[at : at + BATCH]
        rows = around[own]
        record, column = np.nonzero((back >= rows[:, -2:-1]) & (back <= rows[:, -1:]))
        # Compared as bytes; all are equally long, so zeros at the end make no difference.
        suffixes = windows[own[record] * width + column].view(f"S{shape.length}").ravel()
        array = np.argsort(suffixes, kind="stable")
        suffixes, ids = suffixes[array], low[own][record[array]]
        first = np.flatnonzero(np.append(True, suffixes[1:] != suffixes[:-1])[: len(array)])
        kind = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(array))))
        old = levels.scan(suffixes[first])
        # Records come by id, so the first of equal suffixes is of the smallest.
        least = np.minimum(old, ids[first])
        out[own[record[array]], back[column[array]]] = least[kind] < ids
        new = old == LAST
        levels.add(suffixes[first][new], ids[first][new])
    return out


def _earlier_strings(prints: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each string, given by two hashes, whether one that is equal has a smaller id."""
    order = np.lexsort((low, prints[1], prints[0]))
    new = np.append(True, (np.diff(prints[:, order]) != 0).any(axis=0))[: len(order)]
    least = low[order][new][np.cumsum(new) - 1] if len(order) else low
    out = np.empty(len(order), dtype=bool)
    out[order] = least < low[order]
    return out


ANSWERED = "block long, shard int, answers binary"


def _match(shape: Shape, shards: Shards):
    def run(table: pa.Table) -> pa.Table:
        import zstandard

        rows = table.to_pylist()
        data = [zstandard.decompress(r["around"]) for r in rows]
        low = np.concatenate([np.frombuffer(zstandard.decompress(r["low"]), np.int64) for r in rows])
        if rows[0]["shard"] >= shards.records:
            parts = [np.frombuffer(d, np.uint64).reshape(2, -1) for d in data]
            found = _earlier_strings(np.concatenate(parts, axis=1), low)[:, None]
            lengths = [p.shape[1] for p in parts]
        else:
            parts = [np.frombuffer(d, np.uint8).reshape(-1, shape.around + 2) for d in data]
            found = _earlier(np.concatenate(parts), low, shape)
            lengths = [len(p) for p in parts]
        ends = np.cumsum(lengths)
        bits = [found[e - n : e] for e, n in zip(ends, lengths, strict=True)]
        # Strings have one bit each, which are packed together; records one row of bits each.
        axis = 0 if found.shape[1] == 1 else 1
        return pa.table(
            {
                "block": pa.array([r["block"] for r in rows], pa.int64()),
                "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "answers": pa.array([np.packbits(b, axis=axis).tobytes() for b in bits], pa.binary()),
            }
        )

    return run


CUT = "doc_id long, n_bytes long, n_removed long, spans array<array<int>>, kept binary"


def _cut(shape: Shape, shards: Shards):
    def run(table: pa.Table) -> pa.Table:
        blob, known, answers = _gathered(table)
        own = Block(blob, shape)
        rare, often = own.repeated(known, shards.anchors)
        started = np.zeros(len(own.data) + 1, dtype=np.int32)

        place, first, last, _ = rare
        around, hashes, low, owner, kind = own.records(*rare)
        found = np.zeros((len(around), shape.left + 1), dtype=bool)
        for shard, rows in shards.of_records(hashes):
            bits = np.frombuffer(answers[shard], np.uint8).reshape(len(rows), -1)
            found[rows] = np.unpackbits(bits, axis=1, count=shape.left + 1).view(bool)
        later = owner > low[kind] if len(kind) else np.empty(0, bool)
        for back in range(shape.left + 1):
            at = place - back
            mine = (at >= first) & (at <= last)
            mine &= later | found[kind, back] if len(kind) else mine
            started[at[mine]] = 1

        prints, low, starts, owner, kind = own.strings(often[1], often[2])
        earlier = np.zeros(len(low), dtype=bool)
        for shard, rows in shards.of_strings(prints):
            earlier[rows] = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=len(rows)).view(bool)
        if len(kind):
            started[starts[(owner > low[kind]) | earlier[kind]]] = 1

        total = np.concatenate([[0], np.cumsum(started[:-1], dtype=np.int64)])
        ends = np.arange(1, len(own.data) + 1)
        removed = total[ends] > total[np.maximum(ends - shape.length, 0)]
        rows: list[list] = [[], [], [], [], []]
        for doc, a, b in zip(own.ids.tolist(), own.starts.tolist(), own.ends.tolist(), strict=True):
            gone = removed[a:b]
            count = int(gone.sum())
            spans = []
            if count:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = edges.reshape(-1, 2).tolist()
            data = own.data[a:b]
            for column, value in zip(
                rows,
                (None if doc == LAST else doc, b - a, count, spans, (data[~gone] if count else data).tobytes()),
                strict=True,
            ):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, rows, kinds, strict=True)})

    return run


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    block_bytes: int = 8_000_000,
    shard_anchors: int = 1_000_000,
    shard_records: int = 100_000,
    frequent: int = 20_000,
    shard_strings: int = 1_000_000,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) per row of `docs`, whose ids are integers.

    Removed is every byte covered by a string of `length` bytes that also starts in a document with
    a smaller id; `spans` are the maximal runs, [from, to) in bytes, and `kept` the bytes left. Null
    text is empty. Rows with the same id are one document: they take nothing from each other. Rows
    without an id are one document, after all others.
    """
    shape = Shape(length)
    total = text_bytes(docs, text_col)
    likely = 2 * total // (shape.left + 2)  # anchors expected of so many bytes
    narrow = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    packed = stored(
        narrow.mapInArrow(_pack(block_bytes), "blob binary").withColumn("block", F.monotonically_increasing_id())
    )
    first = blocks(likely, shard_anchors)
    asked = packed.mapInArrow(_ask(shape, first), ASKED)
    known = stored(
        asked.groupBy("shard").applyInArrow(_answer(frequent), KNOWN).where("n + n_frequent > 0")
    )
    # Known now: how many records and strings there are at most; a string starts at one of these places.
    told = known.agg(F.sum("n").alias("n"), F.sum("n_frequent").alias("hot")).first()
    shards = Shards(
        first, blocks(told["n"] or 0, shard_records), blocks((told["hot"] or 0) * (shape.left + 1), shard_strings)
    )
    columns = {"blob": "binary", "shard": "int", "repeated": "binary", "frequent": "binary", "answers": "binary"}

    def rows(df: DataFrame) -> DataFrame:
        there = {c: F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()}
        return df.select("block", *there.values())

    texts = rows(packed).unionAll(rows(known))
    sent = texts.groupBy("block").applyInArrow(_send(shape, shards), SENT)
    answered = sent.groupBy("shard").applyInArrow(_match(shape, shards), ANSWERED)
    return texts.unionAll(rows(answered)).groupBy("block").applyInArrow(_cut(shape, shards), CUT)
